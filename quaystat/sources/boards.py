"""Build nested board snapshots (the raw feed's shape) from observations.

Used to drive the flatten operator with the shared tables: observations are
grouped into one document per (collection instant, stop) — one board read —
and every instant is rendered as ISO-8601 text in local time with its UTC
offset, as the feed does. The group is one board, so its size is bounded by
what one board read returns, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystat.functions.time import EPOCH, epoch_seconds, ntz_literal, to_local
from quaystat.session import qualified

# Fixed value: the "board" variant floors collection instants to 6 hours.
BOARD_SECONDS = 6 * 3600


def _offset_text(utc: Column, local: Column) -> Column:
    minutes = F.call_function("div", epoch_seconds(local) - epoch_seconds(utc), F.lit(60))
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    m = F.abs(minutes)
    return F.concat(sign, F.lpad((m / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((m % 60).cast("string"), 2, "0"))


def iso_local(utc: Column | str, local: Column | str | None = None) -> Column:
    """UTC NTZ -> 'yyyy-MM-ddTHH:mm:ss[.f]+hh:mm' in local time (NULL stays NULL).

    Pass a precomputed ``local`` column when formatting many rows: the zone
    conversion is the expensive part and should run once per value.
    """
    u = F.col(utc) if isinstance(utc, str) else utc
    loc = to_local(u) if local is None else (F.col(local) if isinstance(local, str) else local)
    return F.concat(_iso_text(loc), _offset_text(u, loc))


def _iso_text(ntz: Column) -> Column:
    """'yyyy-MM-ddTHH:mm:ss[.fraction]': the NTZ string cast (no session
    zone, unlike ``date_format``) with the date/time separator as 'T'."""
    text = ntz.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 32))


def iso_utc(utc: Column | str) -> Column:
    u = F.col(utc) if isinstance(utc, str) else utc
    return F.concat(_iso_text(u), F.lit("+00:00"))


def snapshots_from_observations(obs: DataFrame) -> DataFrame:
    """One nested snapshot per (collected_at_utc, stop_place_id)."""
    instants = ["aimed_departure_utc", "expected_departure_utc", "actual_departure_utc"]
    obs = obs.select("*", *[to_local(c).alias(f"_local_{c}") for c in instants])
    call = F.struct(
        F.col("realtime").alias("realtime"),
        iso_local("aimed_departure_utc", "_local_aimed_departure_utc").alias("aimedDepartureTime"),
        iso_local("expected_departure_utc", "_local_expected_departure_utc").alias("expectedDepartureTime"),
        iso_local("actual_departure_utc", "_local_actual_departure_utc").alias("actualDepartureTime"),
        F.when(F.col("quay_id").isNotNull() | F.col("quay_name").isNotNull(),
               F.struct(F.col("quay_id").alias("id"), F.col("quay_name").alias("name"))).alias("quay"),
        F.struct(F.col("destination").alias("frontText")).alias("destinationDisplay"),
        F.struct(
            F.col("service_journey_id").alias("id"),
            F.struct(
                F.struct(
                    F.col("line_id").alias("id"),
                    F.col("line_public_code").alias("publicCode"),
                    F.col("line_name").alias("name"),
                    F.col("transport_mode").alias("transportMode"),
                ).alias("line")
            ).alias("journeyPattern"),
        ).alias("serviceJourney"),
    )
    boards = obs.groupBy("collected_at_utc", "stop_place_id").agg(
        F.max("stop_name").alias("stop_name"), F.collect_list(call).alias("calls")
    )
    return boards.select(
        iso_utc("collected_at_utc").alias("collected_at_utc"),
        F.col("stop_place_id"),
        F.struct(
            F.struct(
                F.col("stop_place_id").alias("id"),
                F.col("stop_name").alias("name"),
                F.col("calls").alias("estimatedCalls"),
            ).alias("stopPlace")
        ).alias("data"),
    )


def board_observations(obs: DataFrame) -> DataFrame:
    """The "board" variant: collection instants floored to 6 hours (integer
    epoch arithmetic, no session zone), so one departure is seen on several
    boards and one board can repeat a call."""
    secs = epoch_seconds("collected_at_utc")
    floored = F.timestamp_add("SECOND", secs - secs % BOARD_SECONDS, ntz_literal(EPOCH))
    return obs.withColumn("collected_at_utc", floored)


def board_snapshots(obs: DataFrame) -> DataFrame:
    """Boards of the "board" variant with the odd documents of a real feed.

    Fixed values: the payload of stop S1 lacks its id; boards of S3 at hour 6 have no
    calls; those of S4 at hour 12 have no payload.
    """
    docs = snapshots_from_observations(board_observations(obs))
    hour = F.substring("collected_at_utc", 12, 2)
    stop = F.col("stop_place_id")
    place = F.col("data.stopPlace")
    emptied = F.filter(place["estimatedCalls"], lambda _: ~((stop == "S3") & (hour == "06")))
    payload = F.struct(F.when(stop != "S1", place["id"]).alias("id"), place["name"].alias("name"), emptied.alias("estimatedCalls"))
    return docs.withColumn("data", F.struct(F.when(~((stop == "S4") & (hour == "12")), payload).alias("stopPlace")))


def land_boards(obs: DataFrame, path: str) -> int:
    """Write board snapshots in the landing layout (see ``snapshots``), one document a file; returns their number.

    A file is written under a temporary name and then moved, so a stream never sees half a document, and a
    task that runs again puts the same document in the same place. A stop has one board an instant.
    """
    at = F.col("collected_at_utc")
    name = F.concat_ws(
        "/",
        F.substring(at, 1, 10),
        F.translate("stop_place_id", ":", "_"),
        F.concat(F.translate(F.substring(at, 1, 19), "-:", ""), F.lit("Z.json")),
    )
    docs = board_snapshots(obs).select(name.alias("name"), F.to_json(F.struct("collected_at_utc", "stop_place_id", "data")).alias("document"))
    root = qualified(obs.sparkSession, path)

    def write(batches):  # pickled by value, so workers need not import this package
        import os
        import posixpath

        import pyarrow as pa
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        made = set()
        for b in batches:
            for name, document in zip(*(c.to_pylist() for c in b.columns), strict=True):
                final = posixpath.join(base, name)
                folder = posixpath.dirname(final)
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                tmp = f"{final}.{os.urandom(6).hex()}.tmp"
                with fs.open_output_stream(tmp) as out:
                    out.write(document.encode("utf-8"))
                if fs.get_file_info(final).type != pafs.FileType.NotFound:
                    fs.delete_file(final)
                fs.move(tmp, final)
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    return docs.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
