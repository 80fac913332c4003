"""Builders for small nested snapshots and flat observations."""

from __future__ import annotations

import copy
import datetime as dt
import json
from pathlib import Path

from quaystat.schema import OBSERVATION_DDL, SNAPSHOT_DDL


def call(
    journey="sj-501",
    aimed="2026-09-17T10:00:00+02:00",
    expected="2026-09-17T10:05:00+02:00",
    actual=None,
    quay=("quay:31", "Pier A"),
    line=("line:8", "8X", "Harbour loop", "rail"),
    realtime=True,
    destination="Upper Mill",
):
    return {
        "realtime": realtime,
        "aimedDepartureTime": aimed,
        "expectedDepartureTime": expected,
        "actualDepartureTime": actual,
        "quay": None if quay is None else {"id": quay[0], "name": quay[1]},
        "destinationDisplay": {"frontText": destination},
        "serviceJourney": {
            "id": journey,
            "journeyPattern": {
                "line": {"id": line[0], "publicCode": line[1], "name": line[2], "transportMode": line[3]}
            },
        },
    }


def snapshot(calls, collected="2026-09-17T08:00:00+00:00", stop_id="stop:204", stop_name="Quayside"):
    return {
        "collected_at_utc": collected,
        "stop_place_id": stop_id,
        "data": {"stopPlace": {"id": stop_id, "name": stop_name, "estimatedCalls": calls}},
    }


def snapshots_df(spark, docs):
    return spark.createDataFrame([copy.deepcopy(d) for d in docs], SNAPSHOT_DDL)


def write_landed(root: str, doc: dict, name: str | None = None) -> Path:
    """Write one snapshot in the landing layout (one JSON document per file)."""
    collected = dt.datetime.fromisoformat(doc["collected_at_utc"])
    stop_dir = doc["stop_place_id"].replace(":", "_")
    rel = name or f"{collected:%Y-%m-%d}/{stop_dir}/{collected:%Y%m%dT%H%M%SZ}.json"
    path = Path(root) / rel
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, indent=2), encoding="utf-8")
    return path


def observations_df(spark, docs):
    from quaystat.operators.flatten import flatten_snapshots

    return flatten_snapshots(snapshots_df(spark, docs))


OBS_DDL = OBSERVATION_DDL
