"""The adjudication log as a stream: refusals, restarts, late rows, cooldown; shards loaded once."""

import json
import os

from wordlake.sources.files import yearly_counts
from wordlake.streaming import log, refused


def put(folder, name, events, at):
    folder.mkdir(exist_ok=True)
    keys = ("seq", "ts", "item_id", "event", "verdict")
    (folder / name).write_text("".join(json.dumps(dict(zip(keys, e))) + "\n" for e in events))
    os.utime(folder / name, (at, at))


DAY = "2026-{:02d}-{:02d}T00:00:00Z"
ONE = [(1, DAY.format(1, 1), "a", "verdict", "word"), (2, DAY.format(1, 2), "a", "search", None), (3, DAY.format(1, 2), "b", "verdict_amend", "not"), (4, DAY.format(1, 3), "c", "verdict", "word")]
TWO = [(5, DAY.format(1, 4), "a", "verdict", "not"), (6, DAY.format(1, 4), "a", "verdict_amend", "not"), (7, DAY.format(1, 5), "b", "verdict", "word"), (8, DAY.format(1, 5), None, "verdict", "word")]


def rows(spark, out):
    return sorted(((r["item_id"], r["seq"], r["status"]) for r in spark.read.parquet(out).collect()), key=repr)


def test_stopped_and_restarted_stream_refuses_what_a_batch_refuses(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(folder, "1.json", ONE, 1_700_000_000)
    run = lambda: log.run_log(log.read_events(spark, str(folder), 1), out, checkpoint)
    run()
    before = rows(spark, out)
    assert before == sorted([("a", 1, "taken"), ("a", 2, "taken"), ("b", 3, "refused"), ("c", 4, "taken")], key=repr)
    run()  # nothing new
    assert rows(spark, out) == before
    put(folder, "2.json", TWO, 1_700_000_100)
    run()
    whole = spark.createDataFrame([e[:1] + e[2:] for e in ONE + TWO if e[2]], "seq long, item_id string, event string, verdict string")
    assert [(i, s) for i, s, status in rows(spark, out) if status == "refused"] == sorted((r["item_id"], r["seq"]) for r in refused(whole).collect())


def test_late_rows_are_dropped_and_items_expire(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: log.run_log(log.read_events(spark, str(folder), 1), out, checkpoint, delay="1 day")
    put(folder, "1.json", [(1, DAY.format(1, 1), "a", "verdict", "word"), (2, DAY.format(6, 1), "b", "verdict", "word")], 1_700_000_000)
    run()
    put(folder, "2.json", [(3, DAY.format(1, 5), "d", "verdict", "word"), (4, DAY.format(8, 1), "b", "search", None)], 1_700_000_100)
    run()
    got = rows(spark, out)
    assert ("d", 3, "taken") not in got  # months behind the watermark
    assert ("a", None, "expired") in got and ("b", None, "expired") not in got
    put(folder, "3.json", [(5, DAY.format(8, 2), "a", "verdict", "not"), (6, DAY.format(8, 2), "b", "verdict", "not")], 1_700_000_200)
    run()
    got = rows(spark, out)
    assert ("a", 5, "taken") in got and ("b", 6, "refused") in got  # a may be judged anew


def test_times_after_2262_are_judged(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: log.run_log(log.read_events(spark, str(folder), 1), out, checkpoint, delay="1 day", days=2)
    put(folder, "1.json", [(1, "2714-01-01T00:00:00.000001Z", "a", "verdict", "word"), (2, "2714-01-01T00:00:00Z", "a", "verdict", "not"), (3, "2714-06-01T00:00:00Z", "b", "verdict", "word")], 1_700_000_000)
    run()
    assert rows(spark, out) == sorted([("a", 1, "refused"), ("a", 2, "taken"), ("b", 3, "taken"), ("a", None, "expired")], key=repr)
    gone = spark.read.parquet(out).where("status = 'expired'").selectExpr("unix_micros(ts) as at", "verdict").first()
    assert tuple(gone) == (23_478_336_000_000_001, "not")


def test_shards_are_loaded_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    for i, text in enumerate(("cat\t1990,5,2\t1991,7,3\ndog\t2000,1,1\n", "cat\t1991,1,1\tbad\n")):
        (folder / f"s{i}.tsv").write_text(text)
        os.utime(folder / f"s{i}.tsv", (1_700_000_000 + i, 1_700_000_000 + i))
    done = []

    def stop(number):
        done.append(number)
        if len(done) == 2:
            raise RuntimeError("lost")

    try:
        log.load_shards(spark, str(folder), out, checkpoint, after=stop)
    except Exception:  # the second load ends after its files are written, before it is committed
        pass
    log.load_shards(spark, str(folder), out, checkpoint, after=done.append)
    assert done == [0, 1, 1]
    (folder / "s2.tsv").write_text("emu\t1995,2,2\n")
    log.load_shards(spark, str(folder), out, checkpoint, after=done.append)
    assert done == [0, 1, 1, 2]
    got = {r["w"]: (r["total_match"], r["total_volume"], r["first_year"], r["last_year"], r["year_count"]) for r in log.merged_shards(spark, out).collect()}
    assert got == {"cat": (13, 6, 1990, 1991, 2), "dog": (1, 1, 2000, 2000, 1), "emu": (2, 2, 1995, 1995, 1)}
    assert yearly_counts(spark, str(folder)).count() == 5
