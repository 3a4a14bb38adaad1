"""A small city for the tests: three trips on one line, five stops, one shape."""

import os
import zipfile

from haltwise.sources.gtfs_realtime import feed_message_class

STOPS = [
    ("9022012000001001", "Alpha", "55.6000", "13.0000"),
    ("9022012000002001", "Beta", "55.6100", "13.0000"),
    ("9022012000003001", "Gamma", "55.6200", "13.0000"),
    ("9022012000004001", "Delta", "55.6300", "13.0000"),
    ("9022012000005001", "Nowhere", "0", "0"),
]
TRIPS = ["t1", "t2", "t3"]
DAY = "20240110"
NOON = 1_704_888_000  # 2024-01-10 12:00:00 UTC


def schedule_texts() -> dict[str, str]:
    stops = "﻿stop_id,stop_name,stop_lat,stop_lon\n" + "".join(
        ",".join(s) + "\n" for s in STOPS
    )
    routes = "route_id,route_short_name,route_long_name\nr1,7,Harbour line\n"
    trips = (
        "trip_id,route_id,service_id,direction_id,trip_headsign,shape_id,block_id,trip_short_name\n"
        "t1,r1,s,0,Delta,sh1,b1,\nt2,r1,s,1,Delta,sh1,b1,\nt3,r1,s,,,sh1,,\n"
    )
    times = "trip_id,stop_sequence,stop_id,arrival_time,departure_time,shape_dist_traveled\n"
    for n, trip in enumerate(TRIPS):
        for i in range(4):
            clock = f"{12 + n}:{i * 5:02d}:00"
            times += f"{trip},{i + 1},{STOPS[i][0]},{clock},{clock},{i * 1112}\n"
    shapes = "shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon,shape_dist_traveled\n"
    for i in range(7):
        shapes += f"sh1,{i + 1},{55.6 + i * 0.005},13.0,{i * 556}\n"
    return {
        "stops.txt": stops,
        "routes.txt": routes,
        "trips.txt": trips,
        "stop_times.txt": times,
        "shapes.txt": shapes,
    }


MAPPING = "trip_id,dated_vehicle_journey_gid\nt1,old\n t1 ,d1\nt2,d2\n,d9\nt4, \n"


def write_schedule(folder) -> str:
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(f"{folder}/skane_static_2024-01-09.zip", "w") as z:
        for name, text in schedule_texts().items():
            z.writestr(name, text)
    with zipfile.ZipFile(f"{folder}/skane_extra_2024-01-09.zip", "w") as z:
        z.writestr("trips_dated_vehicle_journey.txt", MAPPING)
    return str(folder)


def trip_updates(late: int = 100, trips=("t1", "t2")) -> bytes:
    feed = feed_message_class()()
    feed.header.gtfs_realtime_version = "2.0"
    for n, trip in enumerate(trips):
        e = feed.entity.add(id=trip)
        u = e.trip_update
        u.trip.trip_id, u.trip.start_date = trip, DAY
        u.timestamp = NOON
        if n == 0:
            u.vehicle.id, u.vehicle.label = "v1", "bus 1"
        for i in range(4):
            s = u.stop_time_update.add(stop_id=STOPS[i][0], stop_sequence=i + 1)
            at = NOON + n * 3600 + i * 300 + late
            s.arrival.time, s.arrival.delay = at, late
            s.departure.time = at + 30
            if i != 2:
                s.departure.delay = late + 30
    return feed.SerializeToString()


def vehicle_positions(trips=("t1", "t2"), stamp_shift: int = 0) -> bytes:
    feed = feed_message_class()()
    feed.header.gtfs_realtime_version = "2.0"
    for n, trip in enumerate(trips):
        for i in range(7):
            v = feed.entity.add(id=f"{trip}-{i}").vehicle
            v.trip.trip_id, v.trip.start_date = trip, DAY
            v.position.latitude, v.position.longitude = 55.6 + i * 0.005, 13.0001
            v.position.speed = [10.0, 0.0, 0.5, 2.0, 3.0, 12.0, 0.0][i]
            v.position.bearing = 0.0
            v.timestamp = NOON + n * 3600 + i * 150 + 120 + stamp_shift
            v.vehicle.id, v.vehicle.label = f"v{n + 1}", f"bus {n + 1}"
    nameless = feed.entity.add(id="x").vehicle
    nameless.position.latitude, nameless.position.longitude = 1.0, 1.0
    return feed.SerializeToString()


def service_alerts(trip: str = "t2", effect: int = 1) -> bytes:
    feed = feed_message_class()()
    feed.header.gtfs_realtime_version = "2.0"
    a = feed.entity.add(id="a").alert
    a.effect = effect
    a.informed_entity.add().trip.trip_id = trip
    a.informed_entity.add().route_id = "r1"
    a.header_text.translation.add(text="Inställd", language="sv")
    return feed.SerializeToString()


def write_set(folder, stamp: str, feeds: dict[str, bytes]) -> None:
    os.makedirs(folder, exist_ok=True)
    for name, content in feeds.items():
        with open(f"{folder}/{stamp}-skane-{name}.pb", "wb") as f:
            f.write(content)


FIRST = "2024-01-10T12-00-00Z"
SECOND = "2024-01-10T12-10-00Z"


def write_first(folder):
    write_set(
        folder,
        FIRST,
        {
            "TripUpdates": trip_updates(),
            "VehiclePositions": vehicle_positions(),
            "SeviceAlerts": service_alerts(),
        },
    )


def write_second(folder, names=("TripUpdates", "VehiclePositions", "ServiceAlerts")):
    every = {
        "TripUpdates": trip_updates(late=400, trips=("t1", "t3")),
        "VehiclePositions": vehicle_positions(trips=("t1",), stamp_shift=60),
        "ServiceAlerts": service_alerts(trip="t9", effect=3),
    }
    write_set(folder, SECOND, {n: every[n] for n in names})
