"""Files that the JSON sink writes."""

from pyspark.sql import functions as F

from jobsignals.sources.tables import write_json


def parts(folder):
    return sorted(p.stat().st_size for p in folder.glob("part-*"))


def rows_in(spark, folder):
    return spark.read.json(str(folder)).count()


def test_small_tasks_are_put_together_and_large_ones_split(spark, tmp_path):
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    rows = spark.range(0, 60_000, 1, 12).select("id", F.sha2(F.col("id").cast("string"), 512).alias("digest"))
    write_json(rows, str(tmp_path / "each"))
    assert len(parts(tmp_path / "each")) == 12
    write_json(rows, str(tmp_path / "sized"), file_mb=2)
    sizes = parts(tmp_path / "sized")
    assert 2 <= len(sizes) < 12 and rows_in(spark, tmp_path / "sized") == 60_000
    assert sizes[-1] < 2 * sum(sizes) / len(sizes)
    write_json(rows.coalesce(1), str(tmp_path / "split"), file_mb=2)
    assert len(parts(tmp_path / "split")) >= 2 and rows_in(spark, tmp_path / "split") == 60_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == advised


def test_few_files_do_not_narrow_the_map(spark, tmp_path):
    tasks = spark.sparkContext.accumulator(0)
    rows = spark.range(0, 1000, 1, 8).mapInArrow(lambda batches: _counted(batches, tasks), "id long")
    write_json(rows, str(tmp_path / "one"), files=1)
    assert len(parts(tmp_path / "one")) == 1 and rows_in(spark, tmp_path / "one") == 1000
    assert tasks.value == 8
    write_json(spark.range(5), str(tmp_path / "one"), files=2)  # replaces what was there
    assert rows_in(spark, tmp_path / "one") == 5


def _counted(batches, tasks):
    tasks.add(1)
    yield from batches
