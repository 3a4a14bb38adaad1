"""Pre-tokens of byte-level BPE, found for a whole batch of texts with array operations."""

from __future__ import annotations

import numpy as np
import pandas as pd

from haltwise.llm.hashing import mix, span_hashes

LETTER, NUMBER, SPACE, BLANK, OTHER = 1, 2, 3, 4, 0
_tables: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and hash value of every code point."""
    if not _tables:
        import regex

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        kind = np.zeros(0x110000, dtype=np.uint8)
        for pattern, k in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
            kind[[ord(c) for c in regex.findall(pattern, every)]] = k
        kind[0x20] = SPACE
        _tables.append(kind)
        _tables.append(mix(np.arange(1, 0x110001, dtype=np.uint64)))
    return _tables[0], _tables[1]


def split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts in a row; start and end of every pre-token; pre-tokens per text.

    The rules are those of the public pattern: the contractions 's 't 're 've 'm 'll 'd; runs of
    letters, of numbers and of other signs, each with one space before it; white space, whose
    last character stands apart (or goes with the run after it) unless the text ends there.
    """
    kinds, _ = tables()
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    n = len(codes)
    if n == 0:
        none = np.empty(0, dtype=np.int64)
        return codes, none, none, np.zeros(len(texts), dtype=np.int64)
    kind = kinds[codes]
    white = kind >= SPACE
    edges = np.cumsum(sizes)
    first = np.zeros(n + 1, dtype=bool)  # where a text begins; n counts as one
    first[0] = True
    first[edges] = True
    run = np.where(white, np.uint8(BLANK), kind)
    begin = first.copy()
    begin[1:n] |= run[1:] != run[:-1]
    # the last white character before a run is a start of its own ...
    last_white = np.zeros(n, dtype=bool)
    last_white[:-1] = white[:-1] & begin[1:n] & ~first[1:n]
    # ... and a plain space takes the run after it along
    taken = np.zeros(n + 1, dtype=bool)
    taken[1:n] = last_white[:-1] & (kind[:-1] == SPACE)
    opens = begin.copy()
    opens[:n] |= last_white
    opens &= ~taken
    # contractions: an apostrophe that opens a pre-token and is followed by letters
    mark = np.flatnonzero((codes == 0x27) & opens[:n])
    mark = mark[mark + 1 < n]
    mark = mark[(kind[mark + 1] == LETTER) & ~first[mark + 1]]
    if len(mark):
        a = codes[mark + 1]
        after = np.minimum(mark + 2, n - 1)
        b = np.where((mark + 2 < n) & ~first[np.minimum(mark + 2, n)], codes[after], 0)
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = np.zeros(len(mark), dtype=bool)
        for x, y in ("re", "ve", "ll"):
            long |= (a == ord(x)) & (b == ord(y))
        hit = short | long
        opens[mark[hit] + 1] = False
        opens[mark[hit] + np.where(short[hit], 2, 3)] = True
    opens[edges] = True
    at = np.flatnonzero(opens)
    starts, ends = at[:-1], at[1:]
    before = np.searchsorted(starts, np.concatenate([[0], edges]), side="left")
    return codes, starts, ends, np.diff(before)


def distinct(
    texts: list[str],
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of a batch, most frequent first; each pre-token's number in that list;
    pre-tokens per text."""
    codes, starts, ends, counts = split(texts)
    if len(starts) == 0:
        return [], np.empty(0, dtype=np.int64), counts
    h = span_hashes(codes, starts, ends, tables()[1])
    number, _ = pd.factorize(h)
    often = np.bincount(number)
    at = np.empty(len(often), dtype=np.int64)
    at[number[::-1]] = np.arange(len(number))[::-1]
    order = np.argsort(-often, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    at = at[order]
    joined = "".join(texts)
    words = [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
    return words, rank[number], counts


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices offset, offset + 1, ... of every row, one row after the other."""
    total = int(lengths.sum())
    shift = np.repeat(offsets - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return shift + np.arange(total)


class Pieces:
    """Ids of many words in one array, by word number."""

    def __init__(self, flat: np.ndarray, length: np.ndarray):
        self.flat = flat
        self.length = length
        self.offset = np.cumsum(length) - length

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of a row of words."""
        return self.flat[ragged(self.offset[numbers], self.length[numbers])]

    def sizes(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of each text, given the words of all texts and the words per text."""
        sums = np.concatenate([[0], np.cumsum(self.length[numbers])])
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]


class WordEncoder:
    """Encodes lists of pre-tokens with a public byte-level vocabulary, one call per list.

    `path` names ranks (.tiktoken) or a tokenizer description (.json) whose vocabulary is
    byte-level; a description's special strings have ids of their own.
    """

    def __init__(self, path: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.special: dict[str, int] = {}
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                described = json.load(f)
            self.special = {x["content"]: x["id"] for x in described["added_tokens"]}
            back = {c: b for b, c in byte_signs().items()}
            ranks = {
                bytes(back[c] for c in word): i
                for word, i in described["model"]["vocab"].items()
                if word not in self.special
            }
        else:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        top = max([*ranks.values(), *self.special.values()]) + 1
        named = {i: b for b, i in ranks.items()}
        named |= {i: s.encode() for s, i in self.special.items()}
        self.token_bytes = [named.get(i, b"") for i in range(top)]
        self.token_length = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.token_offset = np.cumsum(self.token_length) - self.token_length
        self.token_data = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)

    def encode(self, words: list[str]) -> Pieces:
        """Words are joined by line ends, which always stand apart, encoded at once and cut
        again where their bytes end; white space goes one by one."""
        length = np.zeros(len(words), dtype=np.int64)
        blank = [i for i, w in enumerate(words) if w.isspace()]
        alone = {i: self.encoding.encode_ordinary(words[i]) for i in blank}
        rest = [i for i in range(len(words)) if i not in alone]
        joined = "\n".join([words[i] for i in rest])
        got = np.array(self.encoding.encode_ordinary(joined), dtype=np.uint32)
        size = np.fromiter((len(words[i].encode()) for i in rest), np.int64, count=len(rest))
        begin = np.cumsum(size + 1) - size - 1
        starts = np.cumsum(self.token_length[got]) - self.token_length[got]
        low = np.searchsorted(starts, begin)
        length[rest] = np.searchsorted(starts, begin + size) - low
        for i, ids in alone.items():
            length[i] = len(ids)
        flat = np.empty(int(length.sum()), dtype=np.uint32)
        offset = np.cumsum(length) - length
        flat[ragged(offset[rest], length[rest])] = got[ragged(low, length[rest])]
        for i, ids in alone.items():
            flat[offset[i] : offset[i] + len(ids)] = ids
        return Pieces(flat, length)

    def decode(self, ids: np.ndarray) -> bytes:
        """Joins ids with the table of token bytes."""
        return self.token_data[ragged(self.token_offset[ids], self.token_length[ids])].tobytes()

    def count(self, text: str) -> int:
        """Ids of a text."""
        return len(self.encoding.encode_to_numpy(text, allowed_special="all"))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and ids per text; special strings have their own ids."""
        out = [np.empty(0, dtype=np.uint32)]
        for t in texts:
            # an array at once, without a list of numbers
            out.append(self.encoding.encode_to_numpy(t, allowed_special="all"))
        return np.concatenate(out), np.array([len(x) for x in out[1:]], dtype=np.int64)


def byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies write for each byte: printable Latin-1
    characters stand for themselves, the others count up from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in signs]
    return signs | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
