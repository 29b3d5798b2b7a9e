from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

FLIGHT_HEADER = ["Year", "Month", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
                 "UniqueCarrier", "TailNum", "ActualElapsedTime", "CRSElapsedTime", "AirTime",
                 "ArrDelay", "Origin", "Dest", "Distance", "TaxiIn", "Cancelled", "Diverted",
                 "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
                 "LateAircraftDelay"]
AIRPORTS = {"ORD": ("41.98", "-87.90"), "DFW": ("32.89", "-97.04"), "ATL": ("33.64", "-84.43"),
            "LAX": ("33.94", "-118.41"), "SEA": ("47.45", "-122.31")}


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="contrail-tests", shuffle_partitions=8)
    yield s


def flight_rows(n: int = 400, seed: int = 7) -> list[list[str]]:
    """Deterministic flight-like text rows (every field is text, 'NA' for missing)."""
    rng = random.Random(seed)
    carriers = ["AA", "UA", "DL", "WN"]
    places = list(AIRPORTS) + ["XYZ"]  # XYZ has no airport row
    rows = []
    for i in range(n):
        crs_dep = rng.choice([600, 741, 915, 1230, 1545, 1810, 2100, 2359])
        dep = crs_dep + rng.choice([0, 5, 12, 30])
        dep = dep if dep % 100 < 60 else dep + 40
        crs_el = rng.randint(60, 300)
        dist = crs_el * 7 + rng.randint(-20, 20)
        carrier = carriers[i % 4]
        effect = {"AA": 12, "UA": -6, "DL": 3, "WN": 0}[carrier]
        delay = int(0.02 * dist + effect + rng.gauss(0, 2))
        origin, dest = rng.choice(places[:5]), rng.choice(places)
        crs_arr = (crs_dep + crs_el // 60 * 100 + crs_el % 60) % 2400
        rows.append([
            "2008", str(1 + i % 12), str(dep), str(crs_dep), "1200", str(crs_arr),
            carrier, f"N{100 + i % 9}", "100", str(crs_el), "90",
            str(delay), origin, dest, str(dist), "5" if i % 3 else "NA", "0", "0",
            "NA", "NA", "NA", "NA", "NA"])
    return rows


def write_csv(path: str, header: list[str], rows: list[list[str]]) -> str:
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")
    return path


@pytest.fixture()
def flights_csv(tmp_path):
    return write_csv(str(tmp_path / "2008.csv"), FLIGHT_HEADER, flight_rows())


@pytest.fixture()
def airports_csv(tmp_path):
    rows = [[k, "airport " + k, v[0], v[1]] for k, v in AIRPORTS.items()]
    return write_csv(str(tmp_path / "airports.csv"), ["iata", "airport", "lat", "long"], rows)
