"""Upsert, publication, quality engine and streaming."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docmill.operators import upsert
from docmill.plans import publish, quality
from docmill.session import work_dir
from docmill.sources import json_arrays, landed, listing, policy
from docmill.streaming import ingest

BATCH = "source string, external_id string, seq bigint, payload string, payload_hash string"
NOW = "2026-01-02 00:00:00"


def make_batch(spark, rows):
    return spark.createDataFrame([("s", k, i, v, v) for k, i, v in rows], BATCH)


def make_stored(spark, rows):
    return spark.createDataFrame([("s", k, v, v, 1, 1, None) for k, v in rows],
                                 "source string, external_id string, payload string, payload_hash string, "
                                 "first_seen_run bigint, last_seen_run bigint, updated_at timestamp")


def apply(spark, stored, batch, run=2):
    return upsert.upsert(stored, batch, run, F.lit(NOW).cast("timestamp"))


def test_upsert_states(spark):
    stored = make_stored(spark, [("same", "a"), ("changed", "a"), ("unseen", "a"), ("reverted", "a")])
    batch = make_batch(spark, [("same", 1, "a"), ("changed", 1, "b"), ("new", 1, "c"), ("reverted", 1, "b"), ("reverted", 2, "a")])
    rows = {r.external_id: r for r in apply(spark, stored, batch).collect()}
    assert {k: (r.payload, r.first_seen_run, r.last_seen_run, r.updated_at is not None) for k, r in rows.items()} == {
        "same": ("a", 1, 2, False), "changed": ("b", 1, 2, True), "unseen": ("a", 1, 1, False),
        "new": ("c", 2, 2, True), "reverted": ("a", 1, 2, True)}
    again = upsert.ingest_counts(upsert.sequential_status(apply(spark, stored, batch), make_batch(
        spark, [("same", 1, "a"), ("changed", 1, "b"), ("new", 1, "c")])), ["source"]).first()
    assert (again.new, again.changed, again.unchanged) == (0, 0, 3)


def test_sequential_status_of_a_hot_key(spark, monkeypatch):
    """One key holds most rows and spans several ranges; compared with a plain loop."""
    monkeypatch.setattr(upsert, "SEQ_SPAN", 7)
    rng = random.Random(5)
    rows = [("hot", i, rng.choice("ab")) for i in range(1, 60)] + [(f"k{i}", 100 + i, "a") for i in range(10)]
    state, want = {"hot": "a", "k3": "z"}, {}
    stored = make_stored(spark, list(state.items()))
    for key, i, value in rows:
        want[key, i] = "new" if key not in state else "unchanged" if state[key] == value else "changed"
        state[key] = value
    got = upsert.sequential_status(stored, make_batch(spark, rows)).collect()
    assert {(r.external_id, r.seq): r.status for r in got} == want


def counts(spark, values):
    return spark.createDataFrame(list(values.items()), "source string, n bigint")


@pytest.mark.parametrize("expected, indexed, rejected, ok", [
    ({"a": 2, "b": 1}, {"a": 2, "b": 1}, {}, True), ({"a": 2}, {"a": 1}, {}, False), ({"a": 2}, {}, {}, False),
    ({"a": 2}, {"a": 2, "b": 1}, {}, False), ({"a": 2}, {"a": 2}, {"a": 1}, False), ({}, {}, {}, False),
])
def test_gate(spark, expected, indexed, rejected, ok):
    rows = publish.gate_rows(counts(spark, expected), counts(spark, indexed), counts(spark, rejected))
    assert publish.gate(rows).first().publish is ok


def test_rebuild_publishes_only_when_counts_agree(spark):
    root = work_dir(spark, "t")
    docs = spark.createDataFrame([("a", 1), ("a", 2)], "source string, x int")
    none, now = counts(spark, {}), F.lit(NOW).cast("timestamp")
    publish.rebuild(spark, docs, counts(spark, {"a": 2}), none, root, "decisions", "decisions_20260101_000000", now)
    refused = publish.rebuild(spark, docs, counts(spark, {"a": 3}), none, root, "decisions", "decisions_20260102_000000", now).first()
    assert not refused.published and refused.reason == "counts differ: a (expected 3, indexed 2, rejected 0)"
    assert not Path(root.removeprefix("file:"), "decisions_20260102_000000").exists()
    assert publish.current_path(spark, f"{root}/versions", "decisions").endswith("decisions_20260101_000000")


EXPECT = [quality.Check("c", "validity", "error", "", {"default": ("==", 0), "b": ("<=", "1.5"), "gone": ("==", 0)}),
          quality.Check("free", "validity", "warning", "", {"only": ("==", 100)})]


def judge(spark, rows):
    values = spark.createDataFrame(rows, "check_name string, source string, value decimal(38,10)")
    results = quality.evaluate(values, quality.expectations(spark, EXPECT)).collect()
    return {(r.check_name, r.source): r.status for r in results}


def test_evaluation(spark):
    from decimal import Decimal as D

    got = judge(spark, [("c", "a", D(0)), ("c", "b", D("1.5")), ("c", "z", D(1)), ("free", "other", D(3))])
    assert got == {("c", "a"): "pass", ("c", "b"): "pass", ("c", "z"): "fail", ("c", "gone"): "no_data",
                   ("free", "other"): "unchecked", ("free", "only"): "no_data"}


@pytest.mark.parametrize("rows", [
    [("c", "a", None)], [("c", " ", 1)], [("c", None, 1)], [("c", "a", 1), ("c", "a", 2)]])
def test_malformed_results(spark, rows):
    from decimal import Decimal as D

    got = judge(spark, [(c, s, None if v is None else D(v)) for c, s, v in rows])
    assert got[("c", None)] == "query_error" and ("c", "gone") not in got


@pytest.mark.parametrize("value, op, bound, want", [
    ("100", "==", "100.00", True), ("99.99", "==", "100", False), ("1", "<=", "1", True), ("1", "<", "1", False),
    ("1", ">=", "1", True), ("1", ">", "1", False), ("0.98", ">=", "0.98", True)])
def test_operators(spark, value, op, bound, want):
    row = spark.range(1).select(quality.holds(F.lit(value), F.lit(op), F.lit(bound)).alias("h")).first()
    assert row.h is want


def test_failing_checks_are_isolated(spark):
    data = spark.createDataFrame([("a", "x"), ("b", "y")], "source string, t string")
    checks = [quality.Check("good", "validity", "error", "SELECT source, 0 AS value FROM {d}", {"default": ("==", 0)}),
              quality.Check("syntax", "validity", "error", "SELEC nothing", {}),
              quality.Check("runtime", "validity", "error", "SELECT source, CAST(t AS INT) AS value FROM {d}", {"default": ("==", 0)}),
              quality.Check("text", "validity", "warning", "SELECT source, t AS value FROM {d}", {"default": ("==", 0)})]
    got = {(r.check_name, r.source): r.status for r in quality.run_checks(spark, checks, {"d": data}).collect()}
    assert got == {("good", "a"): "pass", ("good", "b"): "pass", ("syntax", None): "query_error",
                   ("runtime", None): "query_error", ("text", None): "query_error"}


def test_scan_stops_at_first_page_without_cursor(spark):
    pages = spark.createDataFrame([("s", 0, "p=1", ["1", "2"]), ("s", 1, None, ["3"]), ("s", 2, "p=3", ["4"]),
                                   ("t", 0, "p=1", ["5"]), ("t", 1, "p=2", []), ("t", 2, None, ["6"])],
                                  "scan string, page bigint, next_batch string, r array<string>")
    pages = pages.withColumn("results", F.transform("r", lambda x: F.parse_json(x)))
    got = landed.page_records(pages).select(F.expr("cast(v as int)").alias("x"), "seq").orderBy("x").collect()
    assert [r.x for r in got] == [1, 2, 3, 5]


def test_listing_structure_errors(spark):
    card = ('<div class="views-row"><div class="search-index" data-history-node-id="7"><h2><a href="/fr/x">'
            '<span class="field--name-field-id">26-D-01</span> relative &agrave; <b>X</b></a></h2></div></div>')
    pages = spark.createDataFrame([(1, card), (2, "<p>nothing</p>"), (3, card.replace("field--name-field-id", "other"))],
                                  "page_id bigint, html string")
    rows = {r.page_id: r for r in listing.parse_listing(pages, "https://h").collect()}
    assert (rows[1].id_decision, rows[1].title, rows[1].url, rows[1].decision_type) == ("26-D-01", "relative à X", "https://h/fr/x", None)
    assert rows[2].error == "no card" and rows[3].error == "no link or number"
    assert listing.structure_gate(listing.parse_listing(pages, "https://h")).first().accepted is False


def test_url_policy(spark):
    urls = spark.createDataFrame([("https://a.org/l",), ("https://a.org/l?page=1",), ("https://b.org/l?page=1",)], "url string")
    rules = spark.createDataFrame([("a.org", "/*?")], "host string, pattern string")
    assert {r.url for r in policy.allowed_urls(urls, rules).collect()} == {"https://a.org/l", "https://b.org/l?page=1"}


def drawn_json(rng, depth=0):
    pick = rng.random()
    if depth > 2 or pick < 0.4:
        return rng.choice(["}", '{"', "a\\", '\\"}', "]},{[", 'é\n"', "", 5, None, True, "x" * rng.randrange(50)])
    if pick < 0.7:
        return [drawn_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b", '}"']): drawn_json(rng, depth + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("split", [900, 6000])
def test_array_files_are_read_by_many_tasks(spark, split):
    """Drawn elements with braces, quotes and backslashes in strings; splits smaller than records, at any place: the elements of
    each file are those of the whole file, broken ones give a row of nulls."""
    rng = random.Random(split)
    folder = work_dir(spark, "arrays")
    Path(folder).mkdir(parents=True)
    want = []
    for i, n in enumerate([0, 1, 40, 60]):
        rows = [{"id": j, "f": drawn_json(rng), "g": "long " * 400 if j % 20 == 5 else drawn_json(rng)} for j in range(n)]
        Path(f"{folder}/f{i}.json").write_text(
            json.dumps(rows, indent=[None, 2, None, 1][i], ensure_ascii=bool(i % 2)) + ("\n" if i % 2 else ""))
        want += [(r["id"], json.dumps(r["f"], sort_keys=True), json.dumps(r["g"], sort_keys=True)) for r in rows]
    Path(f"{folder}/empty.json").write_text("")
    Path(f"{folder}/torn.json").write_text('[{"id": 7}, {"id": 8, "f": "}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        parts = spark.read.option("lineSep", "}").text(folder).select(F.spark_partition_id()).distinct().count()
        rows = json_arrays.read_array(spark, folder, "id bigint, f variant, g variant").selectExpr(
            "id", "CAST(to_json(f) AS STRING) AS f", "CAST(to_json(g) AS STRING) AS g").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    text = lambda v: "null" if v is None else json.dumps(json.loads(v), sort_keys=True)
    got = [(r.id, text(r.f), text(r.g)) for r in rows]
    torn = [g for g in got if g not in set(want)]
    assert parts > 4 and sorted(torn, key=str) == [(7, "null", "null"), (None, "null", "null")]
    assert sorted(g for g in got if g not in set(torn)) == sorted(want)


def test_stream_equals_batch_and_survives_replay(spark):
    """Three landings (new, reverted and unchanged content) give the batch result; writing the
    last micro-batch again, as after a lost driver, changes nothing."""
    landings = [[("a", 1, "1"), ("b", 1, "1")], [("a", 2, "2"), ("c", 2, "1")], [("a", 3, "1"), ("b", 3, "1")]]
    log = work_dir(spark, "log")
    spark.createDataFrame([], ingest.LOG).write.parquet(f"{log}/batch_id=-1/bucket=-1")
    stored = make_stored(spark, [])
    for i, rows in enumerate(landings):
        ingest.append_changes(spark, make_batch(spark, rows), i, log)
        stored = apply(spark, stored, make_batch(spark, rows), i)
    columns = ["external_id", "payload", "payload_hash", "first_seen_run", "last_seen_run"]
    want = sorted(tuple(r) for r in stored.select(*columns).collect())
    assert sorted(tuple(r) for r in ingest.current_state(spark, log).select(*columns).collect()) == want
    ingest.append_changes(spark, make_batch(spark, landings[2]), 2, log)
    assert sorted(tuple(r) for r in ingest.current_state(spark, log).select(*columns).collect()) == want


def test_stream_restart(spark):
    path, log, state = work_dir(spark, "in"), work_dir(spark, "log"), work_dir(spark, "state")
    for rows in ([("a", 1, "1")], [("a", 2, "2"), ("b", 2, "1")]):
        make_batch(spark, rows).write.mode("append").parquet(path)
        ingest.start_upsert(ingest.read_table_stream(spark, path, BATCH), log, state).awaitTermination()
    rows = {r.external_id: r for r in ingest.current_state(spark, log).collect()}
    assert rows["a"].payload == "2" and rows["a"].first_seen_run < rows["a"].last_seen_run and rows["b"].payload == "1"


def test_keyed_state_equals_batch_and_costs_what_a_batch_brings(spark):
    """Random landings, a hot key among them, one file a micro-batch and a restart after each: statuses and stored rows are those of
    the batch upsert, and a micro-batch touches the state of its own keys alone, on disk."""
    rng = random.Random(4)
    path, log, state = work_dir(spark, "in"), work_dir(spark, "log"), work_dir(spark, "state")
    stored, touched, want = make_stored(spark, []), [], []
    for n in range(4):
        rows = [(f"k{rng.randrange(400 if n == 0 else 12)}", i, str(rng.randrange(3))) for i in range(500 if n == 0 else 8)]
        rows += [("hot", 1000 + i, str(i % 2)) for i in range(300)] + [("torn", 1, None)]
        batch = make_batch(spark, rows)
        batch.coalesce(1).write.mode("append").parquet(path)
        query = ingest.start_keyed_upsert(ingest.read_table_stream(spark, path, BATCH), log, state)
        query.awaitTermination()
        operators = query.lastProgress.stateOperators
        assert any("rocksdb" in name for name in operators[0].customMetrics)
        touched.append((operators[0].numRowsUpdated, len({k for k, _, v in rows if v is not None})))
        keys = {r.external_id: r for r in upsert.decisions(stored, batch).collect()}
        want += [(n, k, "new" if not r.known else "changed" if r.differs else "unchanged") for k, r in keys.items()]
        stored = apply(spark, stored, batch, n)
    seen = spark.read.schema(f"{ingest.LOG}, batch_id BIGINT").parquet(log)
    assert sorted((r.batch_id, r.external_id, r.status) for r in seen.collect()) == sorted(want)
    assert all(updated <= brought for updated, brought in touched) and touched[0][1] > 250 and max(b for _, b in touched[1:]) <= 13
    columns = ["external_id", "payload", "payload_hash", "first_seen_run", "last_seen_run"]
    now = sorted(tuple(r) for r in ingest.current_state(spark, log).select(*columns).collect())
    assert now == sorted(tuple(r) for r in stored.select(*columns).collect())
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ingest.STATE_STORE["spark.sql.streaming.stateStore.providerClass"]


def test_keys_of_a_block_share_a_state(spark, monkeypatch):
    """Far more keys than blocks, and a restart: one state row a block, statuses key by key, the same ids in two sources."""
    monkeypatch.setattr(ingest, "STATE_BLOCKS", 8)
    path, log, state, updated = work_dir(spark, "in"), work_dir(spark, "log"), work_dir(spark, "state"), []
    for rows in ([(s, str(i), 1, "a", "a") for s in "st" for i in range(300)], [("s", str(i), i, "ab"[i % 2], "ab"[i % 2]) for i in range(295, 310)]):
        spark.createDataFrame(rows, BATCH).coalesce(1).write.mode("append").parquet(path)
        query = ingest.start_keyed_upsert(ingest.read_table_stream(spark, path, BATCH), log, state)
        query.awaitTermination()
        updated.append(query.lastProgress.stateOperators[0].numRowsUpdated)
    second = spark.read.schema(f"{ingest.LOG}, batch_id BIGINT").parquet(log).filter("batch_id = 1")
    want = [("s", str(i), "new" if i >= 300 else "changed" if i % 2 else "unchanged") for i in range(295, 310)]
    assert sorted((r.source, r.external_id, r.status) for r in second.collect()) == sorted(want)
    assert updated[0] == 8 and 0 < updated[1] <= 8
    assert ingest.current_state(spark, log).count() == 610


def test_unreadable_payloads_store_nothing(spark):
    rows = [("s", "good", 1, "a", "a"), ("s", "good", 2, "{", None), ("s", "only", 1, "{", None), ("s", "kept", 1, "{", None)]
    batch, stored = spark.createDataFrame(rows, BATCH), make_stored(spark, [("kept", "z")])
    got = {r.external_id: (r.payload, r.last_seen_run) for r in apply(spark, stored, batch).collect()}
    assert got == {"good": ("a", 2), "kept": ("z", 1)}
    counts = upsert.ingest_counts(upsert.sequential_status(stored, batch), ["source"]).first()
    assert (counts.fetched, counts.new, counts.quarantined, counts.missing_id) == (4, 1, 3, 0)


def test_late_records_are_kept_once(spark):
    """One file a micro-batch, newest first: nothing is late enough to be lost."""
    path, out = work_dir(spark, "late"), work_dir(spark, "late-out")
    for day in (28, 1, 15, 28):
        spark.createDataFrame([(day, i) for i in range(5)], "day int, id int").selectExpr(
            "id + 100 * day AS id", "make_timestamp(2026, 1, day, 0, 0, 0) AS ts").coalesce(1).write.mode("append").parquet(path)
    stream = ingest.read_table_stream(spark, path, "id int, ts timestamp", files_per_trigger=1)
    ingest.append_to(ingest.drop_rereads(stream, ["id", "ts"]), out, work_dir(spark, "late-state"))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == sorted(i + 100 * d for d in (1, 15, 28) for i in range(5))


def test_work_folder_without_shared_setting(spark, monkeypatch):
    from docmill import session

    class Bare:
        """A session whose configuration names no shared folder."""

        def __init__(self, master):
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})

    first, second = (session.work_dir(Bare("local[4]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(ValueError):
        session.work_dir(Bare("spark://host:7077"), "x")


def test_rule_with_a_dollar_inside(spark):
    rules = spark.createDataFrame([("h.org", "/a$b"), ("h.org", "/c$")], "host string, pattern string")
    pages = spark.createDataFrame([(u,) for u in ("http://h.org/a$b/x", "http://h.org/ab", "http://h.org/c", "http://h.org/cd")], "url string")
    assert sorted(r.url for r in policy.allowed_urls(pages, rules).collect()) == ["http://h.org/ab", "http://h.org/cd"]


def test_snapshots_stand_in_for_the_log(spark, monkeypatch):
    """Seven micro-batches, a snapshot every second one: every status as a plain loop gives it."""
    monkeypatch.setattr(ingest, "COMPACT", 2)
    rng, log, state = random.Random(3), work_dir(spark, "log"), {}
    spark.createDataFrame([], ingest.LOG).write.parquet(f"{log}/batch_id=-1/bucket=-1")
    for n in range(7):
        rows = [(f"k{k}", 1, rng.choice("ab")) for k in rng.sample(range(8), 4)]
        ingest.append_changes(spark, make_batch(spark, rows), n, log)
        want = {k: "new" if k not in state else "unchanged" if state[k] == v else "changed" for k, _, v in rows}
        state |= {k: v for k, _, v in rows}
        wrote = spark.read.parquet(f"{log}/batch_id={n}").collect()
        assert {r.external_id: r.status for r in wrote} == want
    assert {r.external_id: r.payload for r in ingest.current_state(spark, log).collect()} == state


def test_upsert_moves_no_payload_of_unchanged_rows(spark):
    """Small batches: the table's rows stay where they are, and so do the batch's payloads."""
    import re

    stored = make_stored(spark, [(f"k{i}", "a") for i in range(50)])
    path = work_dir(spark, "layer")
    stored.write.parquet(path)
    batch = make_batch(spark, [(f"k{i}", 1, "b" if i == 3 else "a") for i in range(20)] + [("new", 1, "c"), ("new", 2, "d")])
    out = apply(spark, spark.read.schema(stored.schema).parquet(path), batch)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(re.search(r"Exchange (hash|round|range)", line) for line in plan.splitlines()), plan
    rows = {r.external_id: (r.payload, r.first_seen_run, r.last_seen_run, r.updated_at is not None) for r in out.collect()}
    assert len(rows) == 51 and rows["new"] == ("d", 2, 2, True) and rows["k3"] == ("b", 1, 2, True)
    assert all(rows[f"k{i}"] == ("a", 1, 2 if i < 20 else 1, False) for i in range(50) if i != 3)


def test_rereads_move_hashes_alone(spark):
    """No payload goes through the shuffle of a batch whose hashes alone are compared."""
    from catalog import runlog

    rows = runlog.rl_overlap_idempotent(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "max(struct(seq" in plan and "max_by(struct(payload" not in plan
    batch = make_batch(spark, [("a", 1, "1"), ("a", 2, "0"), ("a", 3, None), ("b", 1, "2"), ("torn", 1, None)])
    assert sorted(map(tuple, upsert.last_hashes(batch).collect())) == [("s", "a", 2, "0"), ("s", "b", 1, "2")]
    assert all(r.fetched == r.unchanged for r in rows.collect())


def test_upsert_is_a_plain_loop(spark):
    rng, state = random.Random(8), {f"k{i}": "a" for i in range(12)}
    stored = make_stored(spark, list(state.items()))
    rows = [(f"k{rng.randrange(16)}", i, rng.choice("abc")) for i in range(60)]
    touched = set()
    for key, _, value in rows:
        if state.get(key) != value:
            touched.add(key)
        state[key] = value
    got = {r.external_id: r for r in apply(spark, stored, make_batch(spark, rows)).collect()}
    assert {k: r.payload for k, r in got.items()} == state
    assert {k for k, r in got.items() if r.updated_at is not None} == touched
    assert {k for k, r in got.items() if r.last_seen_run == 2} == {k for k, _, _ in rows}


def test_versions_are_appended_once(spark):
    """One file a micro-batch, days in any order, repeats inside and across them, null keys and moments; a replay adds nothing."""
    path, out, state = work_dir(spark, "reads"), work_dir(spark, "once"), work_dir(spark, "once-state")
    rng, wanted = random.Random(2), set()
    for _ in range(5):
        rows = [(rng.choice([None, *range(6)]), rng.choice([None, *range(1, 6)])) for _ in range(30)]
        wanted |= set(rows)
        spark.createDataFrame(rows, "id int, day int").selectExpr("id", "day AS d", "make_timestamp(2026, 1, day, 0, 0, 0) AS ts").coalesce(1).write.mode("append").parquet(path)
    stream = ingest.read_table_stream(spark, path, "id int, d int, ts timestamp", files_per_trigger=1)
    ingest.append_once(stream, ["id", "d", "ts"], "ts", out, state)
    got = [(r.id, r.d) for r in spark.read.schema("id int, d int, ts timestamp").parquet(out).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    ingest.append_once(stream, ["id", "d", "ts"], "ts", out, state)
    assert spark.read.schema("id int, d int, ts timestamp").parquet(out).count() == len(wanted)


def test_retention_deletes_what_it_drops(spark, tmp_path):
    root = str(tmp_path)
    names = [f"decisions_2026010{i}_020000" for i in range(1, 6)]
    for i, name in enumerate(names):
        (tmp_path / name).mkdir()
        if i not in (1, 4):  # two builds were refused, the newest name among them
            publish.publish(spark, f"{root}/versions", "decisions", name, f"{root}/{name}", F.lit(f"2026-01-0{i + 1} 02:00:00").cast("timestamp"))
    (tmp_path / "decisions_copy").mkdir()
    (tmp_path / "other_20260101_020000").mkdir()
    assert publish.apply_retention(spark, root, f"{root}/versions", "decisions") == [names[0], names[1], names[4]]
    assert {p.name for p in tmp_path.iterdir()} == {names[2], names[3], "decisions_copy", "other_20260101_020000", "versions"}


def test_work_folders_are_removed(spark):
    from docmill import session

    first = session.work_dir(spark, "kept-before")
    mark = session.written_so_far()
    kept, gone = session.work_dir(spark, "kept"), session.work_dir(spark, "gone")
    for path in (first, kept, gone):
        spark.range(3).write.parquet(path)
    session.remove_written(spark, mark, keep=[kept])
    assert spark.read.parquet(first).count() == spark.read.parquet(kept).count() == 3
    assert not publish.exists(spark, gone)
