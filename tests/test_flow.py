"""Landing to predictions on small feeds: the invariants of each layer."""

from datetime import datetime, timedelta

import feeds
import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.plans import clinical as c
from millrace.plans import gold, ingest, model, silver
from millrace.plans.registry import CHALLENGER, CHAMPION, REJECTED, RETIRED, Registry
from millrace.plans.store import BY_MONTH, Store
from millrace.sources import LandingMissing, ParquetTable, read_landing
from millrace.sources.landing import SourceSpec
from millrace.streaming import stream_ingest

NOW = datetime(2030, 1, 1)


def ingest_everything(store, root):
    return [ingest.ingest_tick(store, spec, f"{root}/{name}", now=NOW) for name, spec in c.SOURCES.items()]


def refine_everything(store):
    return {name: silver.refine_source(store, spec, c.RULES.rules_for(name)) for name, spec in c.SOURCES.items()}


def contents(df):
    return sorted(map(str, df.drop("ingestion_timestamp").collect()))


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_read_landing(spark, landing):
    feeds.write_feeds(landing, n=3)
    df = read_landing(spark, c.CLINICAL, f"{landing}/clinical")
    row = df.orderBy("patient_id").first()
    assert row.updated_at == datetime(2024, 1, 1, 3) and row.source_file.endswith("batch_1_0.csv")
    assert df.count() == 3 and dict(df.dtypes)["age"] == "string"
    assert read_landing(spark, c.GAIT, f"{landing}/gait").count() == 15
    with pytest.raises(LandingMissing):
        read_landing(spark, c.GAIT, f"{landing}/nowhere")


def test_files_of_other_columns_are_read_by_their_own_header(spark, landing):
    rng = __import__("random").Random(0)
    row = feeds.label("P1", feeds.START, True)
    turned = {"note": "new", **dict(reversed(feeds.label("P2", feeds.START, False).items()))}
    feeds.write_csv(landing, "labels", "a.csv", [row])
    feeds.write_csv(landing, "labels", "b.csv", [turned])
    feeds.write_csv(landing, "labels", "c.csv", [{"patient_id": "P3", "weight": 2}])
    got = {r.patient_id: r for r in read_landing(spark, c.LABELS, f"{landing}/labels", others=True).collect()}
    assert {p: (r.frailty_label, r.note, r.unreadable) for p, r in got.items()} == {
        "P1": (str(row["frailty_label"]), None, None),
        "P2": (str(turned["frailty_label"]), "new", None),
        "P3": (None, None, "unreadable_time"),
    }
    plain = read_landing(spark, c.LABELS, f"{landing}/labels")
    assert plain.count() == 3 and "note" not in plain.columns and rng


def test_unreadable_rows_are_quarantined_once(spark, store, landing):
    rng = __import__("random").Random(6)
    t, spec, path = feeds.START, c.SPPB, f"{landing}/sppb"
    good = [feeds.sppb(f"P{i}", t + timedelta(minutes=25 * i + 5), rng) for i in range(6)]
    feeds.write_json(landing, "sppb", "a.json", [*good, feeds.sppb("PX", t, rng, survey_date="soon"), feeds.sppb("PY", t, rng, survey_date=None)])
    with open(f"{path}/a.json", "a") as file:
        file.write('{"response_id": "SPZ", "patient_id"')
    results = [ingest.ingest_tick(store, spec, path, start=t, now=NOW) for _ in range(2)]
    feeds.write_json(landing, "sppb", "b.json", [feeds.sppb("PW", t, rng, survey_date="later")])
    results += [ingest.ingest_tick(store, spec, path, now=NOW) for _ in range(2)]
    assert [r.rejected for r in results] == [3, 0, 1, 0] and [r.rows for r in results] == [3, 2, 1, 0]
    assert [r.status for r in results][-1] == ingest.EMPTY_WINDOW
    silver.refine_source(store, spec, c.RULES.rules_for("sppb"))
    bad = {(r.patient_id, r.failed_rules[0], r.watermark_text, r.corrupt_record) for r in silver.quarantined_rows(store, "sppb").collect()}
    assert bad == {
        ("PX", "unreadable_time", "soon", None), ("PY", "unreadable_time", None, None), ("PW", "unreadable_time", "later", None),
        (None, "unreadable_record", None, '{"response_id": "SPZ", "patient_id"'),
    }
    assert silver.silver_counts(store, "sppb") == {"valid": 6, "quarantined": 4}


def test_a_tick_reads_the_folders_of_its_days(spark, store, landing):
    spec = SourceSpec("s", "json", {"k": "STRING", "ts": "TIMESTAMP"}, ("k",), "ts", timedelta(hours=12), day_folder="day")
    read = []
    for days in (2, 4):
        for k in range(days):
            day = feeds.START + timedelta(days=k)
            rows = [{"k": f"{k}-{h}", "ts": feeds.stamp(day + timedelta(hours=h))} for h in (0, 6, 12)]
            feeds.write_json(landing, f"s/day={day.date()}", "a.json", rows)
        scan = read_landing(spark, spec, f"{landing}/s", feeds.START + timedelta(hours=6), feeds.START + timedelta(hours=18))
        read.append(len(scan.inputFiles()))
    assert read == [1, 1]
    results = [ingest.ingest_tick(store, spec, f"{landing}/s", start=feeds.START - timedelta(hours=12)) for _ in range(10)]
    assert sum(r.rows for r in results) == 12 and store.bronze("s").read().count() == 12
    assert results[-1].status == ingest.EMPTY_WINDOW
    assert ingest.ingest_tick(store, spec, f"{landing}/none").status == ingest.NO_LANDING


def test_tick_statuses_and_window_edges(spark, store, landing, tmp_path):
    spec = c.SPPB
    path = f"{landing}/sppb"
    missing = ingest.ingest_tick(store, spec, path)
    assert (missing.status, missing.watermark, missing.skipped) == (ingest.NO_LANDING, None, True)
    (tmp_path / "empty").mkdir()
    assert ingest.ingest_tick(store, spec, str(tmp_path / "empty")).status == ingest.EMPTY_LANDING
    assert ingest.read_watermark(store, "sppb") is None

    t = datetime(2024, 1, 1)
    rng = __import__("random").Random(0)
    rows = [feeds.sppb(f"P{i}", t + timedelta(minutes=m), rng) for i, m in enumerate((0, 1, 60, 61, 200))]
    feeds.write_json(landing, "sppb", "a.json", rows)
    first = ingest.ingest_tick(store, spec, path, start=t)
    assert (first.status, first.rows, first.watermark) == (ingest.INGESTED, 2, t + timedelta(hours=1))
    assert sorted(r.patient_id for r in store.bronze("sppb").read().collect()) == ["P1", "P2"]
    second = ingest.ingest_tick(store, spec, path)
    assert (second.status, second.rows) == (ingest.INGESTED, 1)
    empty = ingest.ingest_tick(store, spec, path)
    assert (empty.status, empty.watermark) == (ingest.EMPTY_WINDOW, t + timedelta(hours=3))
    assert ingest.ingest_tick(store, spec, path).rows == 1
    # Landed too late: its time has passed, so no tick reads it, but the report shows it.
    feeds.write_json(landing, "sppb", "late.json", [feeds.sppb("P9", t + timedelta(minutes=5), rng)])
    assert ingest.ingest_tick(store, spec, path).status == ingest.EMPTY_WINDOW
    late = op.late_rows(read_landing(spark, spec, path), spec.ts_col, ingest.read_watermark(store, "sppb"))
    known = store.bronze("sppb").read().select("response_id")
    assert {r.patient_id for r in late.join(known, "response_id", "left_anti").collect()} == {"P0", "P9"}


def test_ticks_in_any_grouping_give_one_table(spark, landing, tmp_path):
    rng = __import__("random").Random(2)
    t = datetime(2024, 1, 1)
    rows = [feeds.sppb(f"P{i % 7}", t + timedelta(minutes=17 * i), rng) for i in range(40)]
    feeds.write_json(landing, "sppb", "a.json", rows)
    tables = []
    for name, windows in (("one", 1), ("four", 4), ("all", None)):
        store = Store(spark, str(tmp_path / name))
        if windows is None:
            result = ingest.ingest_tick(store, c.SPPB, f"{landing}/sppb", now=NOW)
            assert result.watermark == t + timedelta(minutes=17 * 39)
        else:
            start = t - timedelta(minutes=1)
            for _ in range(12 // windows):
                ingest.ingest_tick(store, c.SPPB, f"{landing}/sppb", start=start, windows=windows, now=NOW)
        tables.append(contents(store.bronze("sppb").read()))
    assert tables[0] == tables[1] == tables[2]
    assert len(tables[0]) == 7


def test_tick_that_ends_after_its_merge_is_repeated_to_no_effect(spark, store, landing, monkeypatch):
    rng = __import__("random").Random(3)
    t = feeds.START
    rows = [feeds.sppb("P1", t + timedelta(minutes=5), rng), feeds.sppb("P2", t + timedelta(minutes=6), rng, response_id=None)]
    feeds.write_json(landing, "sppb", "a.json", [*rows, feeds.sppb("PX", t, rng, survey_date=""), feeds.sppb("P3", t + timedelta(minutes=70), rng)])

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "write_watermark", crash)
        with pytest.raises(RuntimeError):
            ingest.ingest_tick(store, c.SPPB, f"{landing}/sppb", start=t)
    assert ingest.read_watermark(store, "sppb") is None
    again = ingest.ingest_tick(store, c.SPPB, f"{landing}/sppb", start=t)
    assert (again.start, again.rows, again.rejected) == (t, 2, 0)
    assert ingest.ingest_tick(store, c.SPPB, f"{landing}/sppb").rows == 1
    assert sorted(r.patient_id for r in store.bronze("sppb").read().collect()) == ["P1", "P2", "P3"]
    assert store.rejected("sppb").read().count() == 1


def test_bronze_invariants_and_idempotence(spark, store, landing):
    feeds.write_feeds(landing, n=20)
    results = ingest_everything(store, landing)
    assert [r.rows for r in results] == [20, 20, 20, 100, 20]
    for name, spec in c.SOURCES.items():
        bronze = store.bronze(name).read()
        assert op.check_unique(bronze, list(spec.keys)).first().is_unique
        audit = ["ingestion_timestamp", "source_file", "sim_arrival_date", "year", "month"]
        assert all(r.n_null == 0 for r in op.check_not_null(bronze, audit).collect())
    assert len(store.bronze("clinical").read().columns) == 22
    before = contents(store.bronze("sppb").read())
    table = store.bronze("sppb")
    table.merge(table.read(), list(c.SPPB.keys))
    assert contents(table.read()) == before


def test_silver_split(spark, store, landing):
    rng = __import__("random").Random(1)
    at = feeds.START + timedelta(hours=1)
    rows = [
        feeds.clinical("ok", at, False, rng),
        feeds.clinical("old", at, False, rng, age=150),
        feeds.clinical("bad", at, False, rng, age="abc"),
        feeds.clinical("both", at, False, rng, age="", sex="X"),
    ]
    feeds.write_csv(landing, "clinical", "a.csv", rows)
    feeds.write_csv(landing, "labels", "a.csv", [feeds.label("ok", at, True), feeds.label("bad", at, True, label_available_date=at.date().isoformat())])
    ingest_everything(store, landing)
    assert refine_everything(store) == {
        "clinical": silver.WRITTEN, "labels": silver.WRITTEN,
        "sppb": silver.SKIPPED, "lifestyle": silver.SKIPPED, "gait": silver.SKIPPED,
    }
    assert [r.patient_id for r in silver.valid_rows(store, "clinical").collect()] == ["ok"]
    failed = {r.patient_id: r.failed_rules for r in silver.quarantined_rows(store, "clinical").collect()}
    assert failed == {"old": ["valid_age"], "bad": ["valid_age"], "both": ["valid_age", "valid_sex"]}
    assert silver.quarantined_rows(store, "labels").first().failed_rules == ["temporal_coherence"]
    assert silver.silver_counts(store, "clinical") == {"valid": 1, "quarantined": 3}
    assert dict(silver.valid_rows(store, "clinical").dtypes)["age"] == "int"
    report = op.rule_report(silver.valid_rows(store, "clinical"), c.RULES.rules_for("clinical")).collect()
    assert all((r.n_violations, r.n_undecided) == (0, 0) for r in report)


def test_silver_follows_bronze_incrementally(spark, store, landing):
    start = feeds.START
    feeds.write_feeds(landing, n=10, step=timedelta(minutes=30))
    path, rules = f"{landing}/sppb", c.RULES.rules_for("sppb")
    for tick in range(5):
        ingest.ingest_tick(store, c.SPPB, path, start=start, now=NOW)
        assert silver.refine_source(store, c.SPPB, rules) == silver.WRITTEN
        whole = silver.refine(store.bronze("sppb").read(), c.SPPB, rules)
        assert contents(store.silver("sppb").read().select(*whole.columns)) == contents(whole)
    assert len(store.silver("sppb").read().inputFiles()) == 1
    assert silver.refine_source(store, c.SPPB, rules) == silver.UNCHANGED
    # A correction rewrites part of bronze, so its month is replaced.
    changed = store.bronze("sppb").read().limit(1).withColumn("sppb_total", F.lit("99"))
    store.bronze("sppb").merge(changed, list(c.SPPB.keys))
    silver.refine_source(store, c.SPPB, rules)
    assert silver.silver_counts(store, "sppb") == {"valid": 9, "quarantined": 1}
    # So does a change of the rules.
    assert silver.refine_source(store, c.SPPB, {"any_id": "response_id IS NOT NULL"}) == silver.WRITTEN
    assert silver.silver_counts(store, "sppb") == {"valid": 10, "quarantined": 0}


def test_gold_waiting_room_and_rescue(spark, store, landing):
    feeds.write_feeds(landing, n=40, without={"sppb": [0, 1], "gait": [1, 39], "labels": [2]})
    ingest_everything(store, landing)
    refine_everything(store)
    result = gold.run_gold(store, now=NOW)
    assert (result.assembled, result.rescued, result.quarantined) == (37, 0, 2)
    waiting = {r.patient_id: (r.missing_gait, r.missing_sppb, r.missing_lifestyle) for r in store.gold("inference_quarantine").read().collect()}
    assert waiting == {"P0000": (False, True, False), "P0001": (True, True, False)}
    assembled, training = store.gold("assembled").read(), store.gold("training").read()
    assert (len(assembled.columns), len(training.columns)) == (41, 42)
    assert len(store.gold("gait_features").read().columns) == 11
    assert op.check_unique(assembled, [c.ENTITY]).first().is_unique
    assert training.count() == 40 and training.filter("frailty_label IS NULL").count() == 1
    assert training.filter("label_available_date <= snapshot_date").isEmpty()

    again = gold.run_gold(store, now=NOW)
    assert (again.assembled, again.rescued, again.quarantined) == (0, 0, 0)
    # The survey of the first patient arrives late.
    rng = __import__("random").Random(4)
    feeds.write_json(landing, "sppb", "late.json", [feeds.sppb("P0000", feeds.START + timedelta(days=5, minutes=30), rng)])
    assert ingest.ingest_tick(store, c.SPPB, f"{landing}/sppb", now=NOW).status == ingest.INGESTED
    refine_everything(store)
    rescued = gold.run_gold(store, now=NOW)
    assert (rescued.assembled, rescued.rescued, rescued.quarantined) == (1, 1, 0)
    assert {r.patient_id for r in store.gold("inference_quarantine").read().collect()} == {"P0001"}
    overlap = store.gold("inference_quarantine").read().join(store.gold("assembled").read(), "patient_id", "left_semi")
    assert overlap.isEmpty()


def test_gold_without_sources(spark, store, landing):
    assert gold.run_gold(store).status == silver.SKIPPED
    feeds.write_feeds(landing, n=4, without={f: range(4) for f in ("sppb", "lifestyle", "gait", "labels")})
    ingest_everything(store, landing)
    refine_everything(store)
    assert gold.run_gold(store).assembled == 0
    training = store.gold("training").read()
    assert len(training.columns) == 42 and training.filter("sppb_total IS NULL AND frailty_label IS NULL").count() == 4


def test_stream_keeps_the_latest_row_whatever_the_order_of_files(spark, tmp_path):
    spec = SourceSpec("s", "json", {"k": "STRING", "ts": "TIMESTAMP", "v": "STRING"}, ("k",), "ts")
    table = ParquetTable(spark, str(tmp_path / "t"), BY_MONTH)
    for part, (hour, value) in enumerate([("02", "late"), ("01", "early")]):
        spark.createDataFrame([("a", f"2024-01-01 {hour}:00:00", value)], "k STRING, ts STRING, v STRING").write.json(str(tmp_path / f"in/{part}"))
        stream_ingest(table, spec, str(tmp_path / "in"), str(tmp_path / "checkpoint"), max_files=1, now=NOW).awaitTermination()
    assert [(r.k, r.v) for r in table.read().collect()] == [("a", "late")]


def test_stream_equals_batch(spark, landing, tmp_path):
    feeds.write_feeds(landing, n=12)
    stream_table = ParquetTable(spark, str(tmp_path / "stream"), BY_MONTH)
    args = (stream_table, c.GAIT, f"{landing}/gait", str(tmp_path / "checkpoint"))
    stream_ingest(*args, now=NOW).awaitTermination()
    store = Store(spark, str(tmp_path / "batch"))
    ingest.ingest_tick(store, c.GAIT, f"{landing}/gait", now=NOW)
    assert contents(stream_table.read()) == contents(store.bronze("gait").read())
    version = stream_table.modified()
    stream_ingest(*args, now=NOW).awaitTermination()
    assert stream_table.modified() == version
    feeds.write_feeds(landing, n=3, first=20, seed=2)
    stream_ingest(*args, now=NOW).awaitTermination()
    assert stream_table.read().count() == 75


def test_stream_can_suppress_repeats(spark, landing, tmp_path):
    rng = __import__("random").Random(1)
    feeds.write_json(landing, "sppb", "a.json", [feeds.sppb("P1", feeds.START, rng), feeds.sppb("P2", feeds.START, rng)])
    feeds.write_json(landing, "sppb", "b.json", [feeds.sppb("P1", feeds.START, rng)])
    table = ParquetTable(spark, str(tmp_path / "t"), BY_MONTH)
    query = stream_ingest(table, c.SPPB, f"{landing}/sppb", str(tmp_path / "c"), lateness="1 hour", max_files=1)
    query.awaitTermination()
    assert table.read().count() == 2


def test_model_lifecycle(spark, store, landing):
    feeds.write_feeds(landing, n=200, step=timedelta(hours=1))
    ingest_everything(store, landing)
    refine_everything(store)
    gold.run_gold(store, now=NOW)
    assert model.score_new(store)[0] == silver.SKIPPED
    assert model.train_if_due(store, threshold=201).status == silver.SKIPPED

    grid = ((0.1, "l2"), (0.1, "l1"))
    rejected = model.train(store, grid=grid, gates=(1.1, 0.0))
    registry = Registry(store)
    assert (rejected.decision, registry.version_of(REJECTED), registry.version_of(CHAMPION)) == ("rejected_gate", 1, None)

    result = model.train_if_due(store, threshold=0, grid=grid)
    assert result.decision == "champion" and result.test_metrics["auc_roc"] > 0.65
    assert (registry.version_of(CHAMPION), registry.version_of(CHALLENGER)) == (3, None)
    assert len(result.points) == 2 and all(set(p.metrics) == {"train", "val"} for p in result.points)
    assert registry.last_trained_count() == 200
    assert model.train_if_due(store, threshold=1).status == silver.SKIPPED

    # The same data again cannot be strictly better than a champion that has seen the test rows.
    same = model.train(store, grid=grid)
    assert same.decision in ("rejected_champion", "champion")
    if same.decision == "champion":
        assert registry.version_of(RETIRED) == 3
    else:
        assert registry.version_of(CHAMPION) == 3

    status, summary = model.score_new(store)
    assert status == silver.WRITTEN and summary["n"] == 200 == summary["n_pos"] + summary["n_neg"]
    scored = store.gold("predictions").read()
    assert scored.columns == ["patient_id", "frailty_prob", "frailty_pred", "threshold", "champion_version", "scored_at"]
    assert scored.filter("frailty_pred <> CAST(frailty_prob >= 0.5 AS INT) AND frailty_prob <> 0.5").isEmpty()
    assert model.score_new(store)[0] == silver.SKIPPED
    runs = {r.kind: r["count"] for r in registry.runs().groupBy("kind").count().collect()}
    assert runs["training"] == 3 and runs["grid_point"] == 6


def test_features_exclude_outcome(spark):
    task = model.ModelTask()
    df = spark.sql("SELECT 'p' patient_id, 1 age, 2 bmi, 0 frailty_label, current_timestamp() assembly_timestamp")
    assert task.features(df) == ["age", "bmi"]
    leaky = model.ModelTask(hidden=("patient_id",))
    with pytest.raises(ValueError, match="frailty_label"):
        leaky.features(df)


def test_scoring_needs_no_shuffle(spark):
    """A fitted model is one projection over the rows."""
    df = spark.range(60).selectExpr("CAST(id % 7 AS DOUBLE) x", "IF(id % 2 = 0, 'a', NULL) t", "CAST(id % 3 = 0 AS DOUBLE) y")
    fitted = model.fit_final(df, ["x", "t"], "y", 1.0, "l2")
    plan = fitted.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
