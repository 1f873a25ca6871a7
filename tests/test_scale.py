"""What the work for each line costs, seen in the plans and in the files."""

import random
import time

from pyspark.sql import functions as F

from stationlens.functions.values import exact_part, other_part
from stationlens.operators import climate, parse
from stationlens.sources.tables import gsod_lines, lines_by_file, render_files, render_lines
from stationlens.sources.text import read_lines

SF = "/root/testdata/sf0.001"
JIT_LIMIT = 8000  # bytes; the JIT compiler leaves longer methods to the interpreter


def test_generated_methods_are_short_enough_to_be_compiled(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        events = climate.extreme_events(parse.observations(gsod_lines(spark, SF)))
        plan = events._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    stages = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(plan)
    assert stages.size() and max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < JIT_LIMIT
    # The station tables are small: no sort and no second shuffle of the readings for them.
    assert "SortMergeJoin" not in plan.toString()


def test_lines_for_the_climate_job_stand_in_files_of_many_stations(spark, tmp_path):
    lines = read_lines(spark, render_lines(spark, SF, str(tmp_path / "out")))
    want = gsod_lines(spark, SF).select("value")
    assert sorted(r.value for r in lines.select("value").collect()) == sorted(r.value for r in want.collect())
    assert len(lines.inputFiles()) <= spark.sparkContext.defaultParallelism + int(
        spark.conf.get("spark.sql.shuffle.partitions")) + 2


def test_rows_become_lines_after_they_are_sorted_into_files(spark):
    plan = lines_by_file(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # The outer operators come first: the lines' expression stands above the sort.
    assert plan.index("concat_ws") < plan.index("Sort [") and "concat_ws" not in plan[plan.index("Sort ["):]


def test_written_station_files_hold_the_lines_once(spark, tmp_path):
    out = render_files(spark, SF, str(tmp_path / "out"))
    lines = read_lines(spark, out)
    want = gsod_lines(spark, SF).select("value")
    assert sorted(r.value for r in lines.select("value").collect()) == sorted(r.value for r in want.collect())
    names = {f.split("/name=")[1].split("/")[0] for f in lines.inputFiles()}
    assert len(names) == len(lines.inputFiles()) == spark.read.parquet(f"{SF}/supplier.parquet").count() + 25
    assert all(f.endswith(".gz") for f in lines.inputFiles())


def test_constant_fields_that_follow_each_other_are_one_text(spark):
    plan = gsod_lines(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert '8","999.9","8","9999.9","8","999.9","8","999.9","8' in plan


def test_one_pattern_reads_a_plain_line(spark):
    plan = parse.parsed_lines(gsod_lines(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    # The replaced text is all that is cut; of the exact expressions only those of odd lines are left.
    assert "generate explode(array(split(_r#" in plan.lower() or "explode(array(split(_r#" in plan.lower()
    pattern = parse.plain_line()
    plain = gsod_lines(spark, SF).where(F.regexp_replace("value", *pattern).startswith(parse.MARK)).count()
    assert plain > 0.97 * gsod_lines(spark, SF).count()


def test_readings_of_letters_take_the_pattern_too(spark):
    """A reading such as n/a is no reason for the exact expressions, which cost some 20 plain lines."""
    def line(reading, sep):
        texts = ["1"] * 28
        for name, i in parse.FIELD_INDEX.items():
            texts[i] = reading if name in ("TEMP", "GUST") else "2001-02-03" if name == "DATE" else "3"
        return sep.join(f'"{t}"' for t in texts)

    letters = ["n/a", "NaN", "nan", "inf", "Infinity", "iNFINITY", "infinit", "d", "F", "N/A/", "/"]
    others = ["", "-", "+nan", "-inf", "1d", "0x1", "1e3", "n a", "1_0", ".5", "\u0660", "1 f"]
    rows = [(line(x, sep), x) for x in letters + others for sep in (",", ", ")]
    lines = spark.createDataFrame(rows, "value string, reading string")
    plain = F.regexp_replace("value", *parse.plain_line()).startswith(parse.MARK)
    assert {r.reading for r in lines.where(plain).collect()} == set(letters)
    fast = parse.parsed_lines(lines, ("value",)).collect()
    exact = lines.select("value", parse._any_record(F.col("value")).alias("p")).select("value", "p.*").collect()
    assert sorted(map(repr, fast)) == sorted(map(repr, exact))


def test_a_long_line_that_is_nearly_plain_is_refused_at_once(spark):
    """Greedy runs must not try one after another: these lines fail at their last field."""
    ends = ['x"y', '"', " "]
    rows = [(sep.join(['"' + " " * 300 + "1" * 300 + " " * 300 + '"'] * 27 + [end]),) for sep in (",", ", ") for end in ends]
    began = time.monotonic()
    plain = F.regexp_replace("value", *parse.plain_line()).startswith(parse.MARK)
    spark.createDataFrame(rows, "value string").select(plain).collect()
    assert time.monotonic() - began < 30


def test_plain_lines_have_the_record_of_the_exact_expressions(spark):
    rng = random.Random(3)
    lines = [r.value for r in gsod_lines(spark, SF).select("value").limit(400).collect()]
    lines += [line.replace('"', "") for line in lines[::7]] + [line.replace(", ", ",") for line in lines[::9]]
    for line in list(lines):
        for _ in range(6):
            at = rng.randrange(len(line) + 1)
            put = rng.choice(['"', ",", " ", '""', '",', ',"', ', "', "\t", "\u0001", ".", "-", "_", "e5", "x", " ", " ", ""])
            line = line[:at] + put + line[at + rng.randrange(3):]
            lines.append(line)
    lines += [parse.MARK + line for line in lines[:5]] + ["", parse.MARK, None, ',"a","b"']
    given = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, value string")
    got = parse.parsed_lines(given, ("i",)).collect()
    want = given.select("i", parse.once(parse._any_record(F.col("value"))).alias("p")).select("i", "p.*").collect()
    assert len(got) == len(lines)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_sums_without_texts_of_numbers(spark):
    rng = random.Random(4)
    xs = [round(rng.uniform(-2000, 2000), rng.randrange(9)) for _ in range(2000)]
    xs += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-9, 15) for _ in range(2000)]
    xs += [0.0, -0.0, 1.0005, 0.0000005, 1e5, 99999.9999995, float("nan"), float("inf"), -float("inf"), None]
    x = F.col("x")
    held = F.coalesce(x.try_cast("decimal(18,6)").cast("double") == x, F.lit(False))
    rows = spark.createDataFrame(list(enumerate(xs)), "i long, x double")
    got = rows.groupBy("i").agg(exact_part(x).alias("e"), other_part(x).alias("o"))
    want = rows.groupBy("i").agg(F.sum(F.when(held, x.try_cast("decimal(18,6)"))).alias("e"), F.sum(F.when(~held, x)).alias("o"))
    assert got.schema["e"] == want.schema["e"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
