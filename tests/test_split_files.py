"""Files read split by split, whatever the size of the splits, against the same files read as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from strandloom.sources import formats as fm


@pytest.fixture
def splits(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_fastq(spark, splits, tmp_path, size):
    rng = random.Random(1)
    reads = []
    for i in range(60):
        n = rng.randrange(0, 30)
        # qualities that begin with @ and +, which look like heads
        reads.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+I") for _ in range(n))))
    for k in range(2):
        (tmp_path / f"{k}.fq").write_text("".join(f"@{n} more\n{s}\n+\n{q}\n" for n, s, q in reads[k::2]))
    splits(size)
    df = fm.fastq(spark, str(tmp_path))
    assert sorted(map(tuple, df.collect())) == sorted(reads)
    if size < 1000:
        assert fm.split_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 2


@pytest.mark.parametrize("size", [16, 100, 1 << 20])
def test_wiggle(spark, splits, tmp_path, size):
    rng = random.Random(2)
    text, want = ["track type=wiggle_0", "# comment"], []
    for i in range(12):
        if i % 2:
            text.append(f"fixedStep chrom=c{i} start={i + 1} step={3 + i % 3} span={1 + i % 2}")
            for k in range(rng.randrange(0, 9)):
                text.append(str(k + 0.5))
                want += [(f"c{i}", i + 1 + k * (3 + i % 3) + b, k + 0.5) for b in range(1 + i % 2)]
                if rng.random() < 0.2:
                    text.append("")
        else:
            text.append(f"variableStep chrom=c{i}")
            for k in range(rng.randrange(0, 9)):
                text.append(f"{k * 7} {k}.25")
                want.append((f"c{i}", k * 7, k + 0.25))
    (tmp_path / "a.wig").write_text("\n".join(text) + "\n")
    splits(size)
    assert sorted(map(tuple, fm.wiggle(fm.split_lines(spark, str(tmp_path))).collect())) == sorted(want)


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_feature_table(spark, splits, tmp_path, size):
    text = ">Feature c1\n1\t10\tgene\n\t\t\tnote\tx\n<20\t5\tCDS\n30\t25\n>Feature c2\n7\t>9\tgene\n"
    (tmp_path / "a.tbl").write_text(text)
    splits(size)
    got = sorted(map(tuple, fm.feature_table(fm.split_lines(spark, str(tmp_path))).drop("feature").collect()))
    assert got == [("c1", "CDS", 5, 20, "-", True), ("c1", "CDS", 25, 30, "-", False), ("c1", "gene", 1, 10, "+", False), ("c2", "gene", 7, 9, "+", True)]


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.fq").write_text("")
    assert fm.fastq(spark, str(tmp_path)).count() == 0
    assert fm.wiggle(fm.split_lines(spark, str(tmp_path))).count() == 0
    assert fm.split_lines(spark, str(tmp_path)).where(F.lit(True)).count() == 0
