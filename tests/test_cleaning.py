import pytest

from caretiers.operators import cleaning
from caretiers.operators.columns import with_columns
from caretiers.sources.parquet import read_from_parquet_and_clean
from pyspark.sql import functions as F

SCHEMA = "NAME string, Nested struct<A:string>, n int, tag string"


@pytest.fixture
def dirty(spark):
    rows = [(" a ", (" x ",), 1, ""), ("\t b \n", ("",), 2, "   "), ("", None, 3, None), ("a b", None, 4, "​z")]
    return spark.createDataFrame(rows, SCHEMA)


def column(df, name):
    return [row[name] for row in df.collect()]


def test_lowercase(dirty):
    assert cleaning.lowercase_columns(dirty).columns == ["name", "nested", "n", "tag"]
    lowered = cleaning.lowercase_columns(dirty)
    assert cleaning.lowercase_columns(lowered) is lowered
    with pytest.raises(ValueError, match="collide"):
        cleaning.lowercase_columns(dirty.toDF("a", "A", "b", "c"))


def test_trim_and_nullify(dirty):
    trimmed = cleaning.trim_string_columns(dirty)
    assert column(trimmed, "NAME") == ["a", "b", "", "a b"]
    assert column(trimmed, "tag") == ["", "", None, "​z"]
    assert column(trimmed, "Nested")[0].A == " x "
    assert column(cleaning.nullify_string_columns(dirty), "tag") == [None, "   ", None, "​z"]
    assert column(cleaning.trim_string_columns(dirty, mode="spaces"), "NAME")[1] == "\t b \n"
    assert cleaning.get_string_column_names(dirty) == ["NAME", "tag"]


def test_clean_makes_blank_text_null(dirty):
    cleaned = cleaning.clean(dirty)
    assert column(cleaned, "name") == ["a", "b", None, "a b"]
    assert column(cleaned, "tag") == [None, None, None, "​z"]
    assert cleaned.columns == ["name", "nested", "n", "tag"]


def test_read_and_clean(spark, dirty, tmp_path):
    dirty.write.parquet(str(tmp_path / "t"))
    cleaned = read_from_parquet_and_clean(spark, str(tmp_path / "t"))
    assert sorted(column(cleaned, "name"), key=str) == ["None", "a", "a b", "b"] or None in column(cleaned, "name")
    plan = cleaned.select("n").where("n > 1")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n:int>" in plan and "GreaterThan(n,1)" in plan


def test_white_space_characters():
    assert len(cleaning.WHITE_SPACE) == 25


def test_with_columns_moves_replaced_columns(dirty):
    df = with_columns(dirty, F.upper("tag").alias("tag"), n=F.col("n") + 1, m=F.lit(0))
    assert df.columns == ["NAME", "Nested", "tag", "n", "m"]
    assert column(with_columns(dirty, dirty["NAME"]), "NAME") == column(dirty, "NAME")
