import pytest

from rankmill.plans.serving import lookup, recommend

COLUMNS = ("skin_type string, rank bigint, product_id string, product_name string, category string, "
           "price_krw bigint, score double, has_restricted_ingredient boolean, rec_key string")


@pytest.fixture(scope="module")
def mart(spark):
    rows = [(s, i, f"p{i}", "크림", "c", 1000, 9.5 - i, False, "k") for s in ("dry", "oily") for i in (3, 1, 2)]
    return spark.createDataFrame(rows, COLUMNS)


def test_top_rows_in_rank_order_with_seven_typed_columns(mart):
    out = recommend(mart, "dry", 2)
    assert [r["rank"] for r in out.collect()] == [1, 2]
    assert out.dtypes == [("rank", "bigint"), ("product_id", "string"), ("product_name", "string"),
                          ("category", "string"), ("price_krw", "bigint"), ("score", "double"),
                          ("has_restricted_ingredient", "boolean")]


def test_default_limit(mart):
    assert len(lookup(mart, "oily")) == 3


@pytest.mark.parametrize("segment,limit", [("robot", 10), ("", 1), ("dry' or 1=1 --", 1), ("dry", 0), ("dry", 51),
                                           ("dry", "5"), ("dry", True), ("dry", 1.5)])
def test_bad_parameters_never_reach_a_query(segment, limit):
    with pytest.raises(ValueError):
        recommend(None, segment, limit)


def test_an_empty_answer_is_an_error(mart):
    with pytest.raises(LookupError):
        lookup(mart, "normal")
