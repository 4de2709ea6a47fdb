import json

import pytest

from linkwright.plans import config as configuration
from linkwright.plans.runtime import Deadlines, deadline
from linkwright.sources import tables as S


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


HEADER = "entity_id\tbusiness_name\tbusiness_address\tcountry"


def test_text_stays_text(spark, tmp_path):
    path = write(tmp_path / "a.tsv", HEADER, "S1-1\tNA\t\tIndia", 'S1-2\t"a ""b"" c"\tnull\t')
    rows = [tuple(r) for r in S.read_tsv(spark, path).orderBy("entity_id").collect()]
    assert rows == [("S1-1", "NA", "", "India"), ("S1-2", 'a "b" c', "null", "")]
    assert S.read_tsv(spark, path, limit=1).count() == 1


def test_preprocess_by_country(spark, tmp_path):
    path = write(tmp_path / "a.tsv", HEADER, "S1-1\tＡcme\tx\tIndia", "S1-2\tB\t\tIndia", "S1-3\tC\ty\tFrance")
    counters = S.preprocess_source(spark, path, "S1-", str(tmp_path / "out"))
    assert counters["rows"] == 3 and counters["empty_addresses"] == 1 and counters["countries"] == {"France": 1, "India": 2}
    india = S.read_partition(spark, str(tmp_path / "out"), "india")
    assert india.count() == 2 and india.where("entity_id = 'S1-1'").first()["name_norm"] == "acme"
    assert S.partitions(spark, str(tmp_path / "out")) == ["france", "india"]
    with pytest.raises(ValueError):
        S.preprocess_source(spark, path, "S2-", str(tmp_path / "other"))
    twice = write(tmp_path / "b.tsv", HEADER, "S1-1\ta\tb\tc", "S1-1\ta\tb\tc")
    with pytest.raises(ValueError):
        S.preprocess_source(spark, twice, "S1-", str(tmp_path / "other"))


@pytest.mark.parametrize("rows", [[("S1-1", "S2-1"), ("S1-1", "")], [("S1-1", "S1-2")], [("S1-1", "S2-1,S2-1")], [("", "S2-1")], [("S2-1", "S2-1")]])
def test_bad_truth_is_rejected(spark, rows):
    with pytest.raises(ValueError):
        S.read_truth(spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string"))


def test_truth_is_trimmed(spark):
    frame = spark.createDataFrame([(" S1-1 ", " S2-1, S3-2 ,"), ("S1-2", None)], "source1_entity_id string, matched_entity_ids string")
    rows = {tuple(r) for r in S.truth_links(S.read_truth(frame)).collect()}
    assert rows == {("S1-1", "S2-1"), ("S1-1", "S3-2"), ("S1-2", None)}


def test_lists_round_trip(spark, tmp_path):
    path = str(tmp_path / "out.tsv")
    S.write_list(spark.createDataFrame([("S1-1", "S2-1,S3-1"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string"), path)
    assert open(path, encoding="utf-8").read() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    assert S.read_list(spark, path).count() == 2


def test_converter(spark, tmp_path):
    path = write(tmp_path / "a.tsv", HEADER, "S1-1\ta, b\t\"q\"\tIndia", "S1-2\t\tx\t")
    assert S.tsv_to_csv(spark, path, str(tmp_path / "csv"), S.SOURCE_COLUMNS) == 2


def test_inspect(spark, tmp_path):
    layout = S.Layout(str(tmp_path))
    for path, columns in layout.files().values():
        write(tmp_path / path.removeprefix(str(tmp_path) + "/"), "\t".join(columns))
    assert len(S.inspect(spark, layout)) == 7
    write(tmp_path / "train/train_source1.tsv", "a\tb")
    with pytest.raises(ValueError, match="header"):
        S.inspect(spark, layout)
    (tmp_path / "train/train_source1.tsv").unlink()
    with pytest.raises(ValueError, match="missing"):
        S.inspect(spark, layout)


def test_slugs(spark):
    frame = spark.createDataFrame([(" New  Zealand! ",), ("भारत",), (None,), ("",)], "country string")
    assert [r[0] for r in frame.select(S.country_slug("country")).collect()] == ["new-zealand", "empty", "empty", "empty"]
    assert S.slug_of(" New  Zealand! ") == "new-zealand" and S.slug_of("भारत") == "empty"


def test_safe_child(tmp_path):
    assert S.safe_child(f"{tmp_path}/a", str(tmp_path)) == f"{tmp_path.resolve()}/a"
    for bad in (str(tmp_path), f"{tmp_path}/../x", "/"):
        with pytest.raises(ValueError):
            S.safe_child(bad, str(tmp_path))


def test_reset_stays_inside(spark, tmp_path):
    write(tmp_path / "run/stage/x", "1")
    S.reset(spark, f"{tmp_path}/run/stage", f"{tmp_path}/run")
    assert not (tmp_path / "run/stage").exists() and (tmp_path / "run").exists()
    with pytest.raises(ValueError):
        S.reset(spark, f"{tmp_path}/run", f"{tmp_path}/run")
    with pytest.raises(ValueError):
        S.safe_child("s3a://other/run/x", "s3a://bucket/run")
    assert S.safe_child("s3a://bucket/run/x", "s3a://bucket/run") == "s3a://bucket/run/x"


def test_json(spark, tmp_path):
    for place in (str(tmp_path / "x/y.json"), f"file://{tmp_path}/z.json"):
        S.write_json({"b": 2, "a": ""}, place, spark)
        S.write_json({"b": 1, "a": "é"}, place, spark)
        assert S.read_json(spark, place) == {"a": "é", "b": 1}
    assert json.loads((tmp_path / "x/y.json").read_text()) == {"a": "é", "b": 1}


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "a.tsv", HEADER, 'S1-1\t"a\nb"\tx\tIndia')
    assert [tuple(r) for r in S.read_tsv(spark, path, multi_line=True).collect()] == [("S1-1", "a\nb", "x", "India")]
    assert S.tsv_to_csv(spark, path, str(tmp_path / "csv"), S.SOURCE_COLUMNS, multi_line=True) == 1


def test_missing_partition_is_empty(spark, tmp_path):
    empty = S.read_partition(spark, str(tmp_path / "none"))
    assert empty.isEmpty() and empty.columns[:4] == S.SOURCE_COLUMNS and S.read_partition(spark, str(tmp_path / "none"), "india").isEmpty()


def test_clean_export(spark, tmp_path):
    frame = spark.createDataFrame([("S1-1", "Ａ  B", "x\ty", "India")], "entity_id string, business_name string, business_address string, country string")
    S.export_clean(frame, str(tmp_path / "clean"))
    columns = [*S.SOURCE_COLUMNS, *(f"{c}_clean" for c in S.SOURCE_COLUMNS[1:])]
    assert [tuple(r) for r in S.read_tsv(spark, str(tmp_path / "clean"), columns).collect()] == [("S1-1", "Ａ  B", "x\ty", "India", "a b", "x y", "india")]


def test_long_list_is_ordered(spark, tmp_path):
    path = f"file://{tmp_path}/many.tsv"
    rows = spark.range(5000).selectExpr("concat('S1-', lpad(id * 7919 % 5000, 6, '0')) AS source1_entity_id", "'' AS matched_entity_ids").repartition(7)
    S.write_list(rows, path)
    lines = (tmp_path / "many.tsv").read_text().splitlines()
    assert len(lines) == 5001 and lines[1:] == sorted(lines[1:]) and not (tmp_path / "many.tsv.parts").exists()


@pytest.mark.parametrize(
    "section, key, value",
    [
        ("project", "time_budget_minutes", 0), ("project", "sample_rows_per_file", 0), ("candidate_generation", "method", "x"), ("candidate_generation", "max_candidates_per_query", 501),
        ("candidate_generation", "char_ngram_min", 9), ("training", "validation_fraction", 0.5), ("training", "threshold_steps", 1), ("training", "device", "tpu"),
        ("training", "tuning_timeout_seconds", 10**9), ("project", "output_reserve_minutes", 480), ("embeddings", "max_minutes", 0),
    ],
)
def test_invalid_configuration(section, key, value):
    with pytest.raises(ValueError):
        configuration.load(**{section: {key: value}})


def test_configuration(tmp_path):
    for profile in configuration.PROFILES:
        configuration.load(profile=profile)
    with pytest.raises(ValueError, match="training.typo_trials"):
        configuration.load(training={"typo_trials": 3})
    path = write(tmp_path / "c.yaml", "project:", "  seed: 7")
    one = configuration.load(path)
    assert one["project"]["seed"] == 7 and one["training"] == configuration.DEFAULTS["training"]
    assert len(configuration.config_hash(one)) == 12 and configuration.config_hash(one) != configuration.config_hash(configuration.load())
    assert configuration.config_hash(one) == configuration.config_hash(one | {"_path": "x"})


def test_deadlines(spark):
    now = [0.0]
    times = Deadlines(10, 2, now=lambda: now[0])
    assert times.seconds_left() == 480 and times.forecast("a", 100) == 0
    with times.stage(spark, "a", 10):
        now[0] += 100
    assert times.forecast("a", 30) == 300
    with pytest.raises(TimeoutError, match="a would take 400 s"):
        with times.stage(spark, "a", 40):
            raise AssertionError("must not begin")
    with times.stage(spark, "a", 40, to_end=True):
        now[0] += 390
    with pytest.raises(TimeoutError):
        with times.stage(spark, "b", 1):
            raise AssertionError("must not begin")


def test_deadline_cancels(spark):
    import time

    from pyspark.sql import functions as F

    @F.udf("int")
    def slow(x):
        time.sleep(30)
        return 1

    with pytest.raises(TimeoutError):
        with deadline(spark, 1.0, "slow-job"):
            spark.range(4).select(slow("id")).collect()
    with deadline(spark, 60, "quick-job"):
        assert spark.range(3).count() == 3
