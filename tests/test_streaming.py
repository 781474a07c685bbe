"""Landing as a stream: reruns and failures at every point of a batch."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from adstrata.sources import bronze
from adstrata.streaming import landing, windows


def write(inbox, name, ids):
    lines = [json.dumps({"id_offre": i, "source": "A b" if i % 2 else None, "date_publication": "2024-03-05"}) for i in ids]
    (inbox / name).write_text("\n".join([*lines, "", "  "]) + "\n")


def ids(spark, zone):
    return sorted(json.loads(r["raw"])["id_offre"] for r in landing.read_landed(spark, zone).collect())


def logs(folder):
    """Log files of a checkpoint or sink by batch, with their checksums."""
    return [p for p in Path(folder).iterdir() if p.name.strip(".").removesuffix(".crc").isdigit()]


def test_landing(spark, tmp_path):
    inbox, zone, checkpoint = tmp_path / "in", str(tmp_path / "zone"), str(tmp_path / "check")
    inbox.mkdir()
    write(inbox, "a.jsonl", range(10))
    write(inbox, "b.jsonl", range(10, 15))
    run = lambda: landing.land(spark, str(inbox), zone, checkpoint, max_files=1)
    run()
    assert ids(spark, zone) == list(range(15))
    run()  # nothing new
    write(inbox, "c.jsonl", range(15, 30))
    run()
    assert ids(spark, zone) == list(range(30))

    # A failure behind the sink's commit: the checkpoint does not know the last batch was done.
    last = max(int(p.name) for p in logs(f"{checkpoint}/commits") if p.name.isdigit())
    for p in logs(f"{checkpoint}/commits"):
        if p.name.strip(".").removesuffix(".crc") == str(last):
            p.unlink()
    run()
    assert ids(spark, zone) == list(range(30))

    # A failure before the sink's commit: its files are there, but no reader sees them; the batch is done again.
    for folder in (f"{checkpoint}/commits", f"{zone}/_spark_metadata"):
        for p in logs(folder):
            if p.name.strip(".").removesuffix(".crc") == str(last):
                p.unlink()
    assert ids(spark, zone) == list(range(15))
    run()
    assert ids(spark, zone) == list(range(30))
    files = list(Path(zone).rglob("*.parquet"))
    assert len(files) > len({r["f"] for r in landing.read_landed(spark, zone).selectExpr("input_file_name() f").collect()})

    rows = bronze.manifest(landing.read_landed(spark, zone)).collect()
    assert {(r["partition"], r["nb_offres"]) for r in rows} == {("a_b/2024_03", 15), ("inconnu/2024_03", 15)}


def test_records_that_are_none(spark, tmp_path):
    inbox, zone = tmp_path / "in", str(tmp_path / "zone")
    inbox.mkdir()
    (inbox / "x.jsonl").write_text('{"id_offre": 1}\nbroken\n"text"\n')
    landing.land(spark, str(inbox), zone, str(tmp_path / "check"))
    report = bronze.integrity_report(landing.read_landed(spark, zone)).first()
    assert (report["total_offres"], report["enregistrements_corrompus"]) == (3, 2)


def test_windows_and_sessions_of_streams_are_those_of_tables(spark, tmp_path):
    schema = "t timestamp, k string, v int"
    at = lambda minutes: f"2024-05-01 {minutes // 60:02d}:{minutes % 60:02d}:00"
    rows = [(m, "ab"[m % 2] if m % 7 else None, m) for m in [*range(0, 90, 3), *range(200, 260, 9), *range(400, 410)]]
    inbox = tmp_path / "in"

    def arrive(part):
        frame = spark.createDataFrame([(at(m) if m is not None else None, k, v) for m, k, v in part], "t string, k string, v int")
        frame.withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(str(inbox))

    arrive(rows[:20])
    forms = {
        "windows": lambda df, delay=None: windows.windows(df, "t", "20 minutes", ["k"], {"n": F.count("*"), "s": F.sum("v")}, delay),
        "sessions": lambda df, delay=None: windows.sessions(df, "t", "15 minutes", ["k"], {"n": F.count("*"), "s": F.sum("v")}, delay),
    }
    run = lambda name: windows.write_final(
        forms[name](spark.readStream.schema(schema).parquet(str(inbox)), "30 minutes"), str(tmp_path / name), str(tmp_path / f"{name}-check")
    )
    assert [run(name) for name in forms] == [0, 0]
    arrive([*rows[20:], (None, "a", 1)])
    assert [run(name) for name in forms] == [0, 0]
    whole = spark.createDataFrame([(at(m), k, v) for m, k, v in rows], "t string, k string, v int").withColumn("t", F.to_timestamp("t"))
    for name, form in forms.items():
        closed = form(whole).where(F.col("window_end") <= F.to_timestamp(F.lit(at(409 - 30))))
        got = spark.read.parquet(str(tmp_path / name))
        assert sorted(map(str, got.collect())) == sorted(map(str, closed.collect())) and closed.count()
    # Events of a closed window are late: counted, and nothing that was written changes.
    before = sorted(map(str, spark.read.parquet(str(tmp_path / "windows")).collect()))
    arrive([(5, "a", 1), (6, "a", 1)])
    assert run("windows") > 0
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "windows")).collect())) == before
