"""Filters, row queries, aggregates and output shaping."""

import datetime
import decimal
import json

import pytest
from pyspark.sql import Row

from vistaflow.model import Filter
from vistaflow.operators.filters import COMPARE, IN_LIST_LIMIT, NULLS, TEXT, as_filters
from vistaflow.operators.shaping import coerce_output, envelope
from vistaflow.plans.exports import export_rows
from vistaflow.plans.query import aggregate, query

SCHEMA = "id int, name string, price decimal(18,2), day date, at timestamp_ntz"


@pytest.fixture(scope="module")
def lots(spark):
    def day(d):
        return datetime.datetime(2026, 1, d, 12)

    rows = [
        (1, "Cap 50%_x", decimal.Decimal("10.50"), day(1).date(), day(1)),
        (2, "cap 50ab", decimal.Decimal("20.00"), day(2).date(), day(2)),
        (3, None, None, day(3).date(), day(3)),
        (4, "Abend", decimal.Decimal("20.00"), None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(
    "condition, expected",
    [
        ({"column": "id", "op": "gte", "value": 2}, [2, 3, 4]),
        ({"column": "ID", "op": "eq", "value": "2"}, [2]),
        ({"column": "id", "op": "lt", "value": 1.5}, [1]),
        ({"column": "name", "op": "ne", "value": "Abend"}, [1, 2]),
        ({"column": "day", "op": "between", "value": ["2026-01-02", "2026-01-03"]}, [2, 3]),
        ({"column": "at", "op": "between", "value": ["2026-01-01", "2026-01-02"]}, [1]),
        ({"column": "day", "op": "between", "value": ["2026-01-03", "2026-01-02"]}, []),
        ({"column": "id", "op": "in", "value": [1, 3, 9]}, [1, 3]),
        ({"column": "name", "op": "is_null"}, [3]),
        ({"column": "name", "op": "is_not_null", "value": "ignored"}, [1, 2, 4]),
        ({"column": "name", "op": "contains", "value": "50%_x"}, [1]),
        ({"column": "name", "op": "contains", "value": "cap"}, [2]),
        ({"column": "name", "op": "startswith", "value": "Ab"}, [4]),
        ({"column": "name", "op": "endswith", "value": "nd"}, [4]),
        ({"column": "price", "op": "contains", "value": "0.5"}, [1]),
        ({"column": "price", "op": "lte", "value": "20.00"}, [1, 2, 4]),
    ],
)
def test_filters(lots, condition, expected):
    assert ids(query(lots, filters=json.dumps([condition]))) == expected


def test_filters_are_a_conjunction(lots):
    both = [Filter("price", "eq", 20), Filter("id", "gt", 2)]
    assert ids(query(lots, filters=both)) == [4]


SHAPES = {"nothing": None, "number": 7, "text": "x", "pair": [1, 2], "triple": [1, 2, 3],
          "none listed": [], "nested": [[1], 2], "object": {"a": 1}}
FITS = {**dict.fromkeys(COMPARE, {"number", "text"}), **dict.fromkeys(TEXT, {"text"}),
        **dict.fromkeys(NULLS, set(SHAPES)), "between": {"pair"}, "in": {"pair", "triple"}}


@pytest.mark.parametrize("op", sorted(FITS))
@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_shape_of_values(op, shape):
    given = [{"column": "id", "op": op, "value": SHAPES[shape]}]
    if shape in FITS[op]:
        assert len(as_filters(given)) == 1
    else:
        with pytest.raises(ValueError):
            as_filters(given)


@pytest.mark.parametrize("op", [None, ["eq"], 3, "equals", ""])
def test_unknown_ops(op):
    with pytest.raises(ValueError):
        as_filters([{"column": "id", "op": op, "value": 1}])


@pytest.mark.parametrize("text", ["{", "{}", "7", '["id"]', '[{"op": "gt", "value": 3}]',
                                  '[{"column": "a-b", "op": "gt", "value": 3}]'])
def test_unusable_filter_text(text):
    with pytest.raises(ValueError):
        as_filters(text)


@pytest.mark.parametrize("pad", [0, IN_LIST_LIMIT])
def test_mixed_lists_mean_the_same_at_any_length(lots, pad):
    more = list(range(10_000, 10_000 + pad))
    assert ids(query(lots, filters=[Filter("id", "in", [1, 2.0, "3", None, *more])])) == [1, 2, 3]


def test_blank_filter_text_is_no_filter():
    assert as_filters(None) == as_filters("  ") == as_filters("[]") == []


def test_equality_pair(lots):
    assert ids(query(lots, filters="[]", filter_by_column="id", filter_value="3")) == [3]
    assert ids(query(lots, filter_by_column="id")) == [1, 2, 3, 4]
    listed = [Filter("id", "eq", 1)]
    assert ids(query(lots, filters=listed, filter_by_column="id", filter_value="3")) == [1]


def test_long_value_list(lots):
    numbers = [Filter("id", "in", list(range(3, IN_LIST_LIMIT + 10)))]
    texts = [Filter("id", "in", [str(i) for i in range(4, IN_LIST_LIMIT + 10)])]
    assert ids(query(lots, filters=numbers)) == [3, 4]
    assert ids(query(lots, filters=texts)) == [4]


def test_select_sort_limit(lots):
    out = query(lots, select="name, id,name ,", sort_by_column="price", sort_order="DESC", limit=3)
    assert out.columns == ["name", "id"]
    assert {r["id"] for r in out.collect()} == {1, 2, 4}
    first = query(lots, sort_by_column="price", limit=1).first()
    assert first["id"] == 3
    assert query(lots, limit=2).count() == 2
    assert query(lots, limit=None).count() == 4


def test_distinct(lots):
    out = query(lots, distinct_column="price", select="id", sort_by_column="id", sort_order="desc")
    assert [r[0] for r in out.collect()] == [decimal.Decimal("10.50"), decimal.Decimal("20.00")]
    some = query(lots, distinct_column="price", filters=[Filter("id", "gt", 1)], limit=1)
    assert [r[0] for r in some.collect()] == [decimal.Decimal("20.00")]


@pytest.mark.parametrize(
    "kwargs",
    [
        {"limit": 0},
        {"sort_order": "asc"},
        {"sort_by_column": "id", "sort_order": "up"},
        {"sort_by_column": "gone"},
        {"select": " , "},
        {"select": "id, na-me"},
        {"select": "gone"},
        {"distinct_column": "gone"},
        {"filters": [Filter("gone", "eq", 1)]},
    ],
)
def test_bad_queries(lots, kwargs):
    with pytest.raises(ValueError):
        query(lots, **kwargs)


def test_aggregates(lots):
    def one(name, **kwargs):
        return aggregate(lots, name, **kwargs).first()[0]

    assert one("count") == 4
    assert one("Sum", agg_column="price") == decimal.Decimal("50.50")
    assert one("avg", agg_column="price") == pytest.approx(50.5 / 3)
    assert one("avg", agg_column="id") == 2.5
    assert one("min", agg_column="name") == "Abend"
    assert one("max", agg_column="day") == datetime.date(2026, 1, 3)
    nothing = [Filter("id", "gt", 99)]
    assert one("count", filters=nothing) == 0
    assert one("sum", agg_column="price", filters=nothing) is None


def test_groups(lots):
    out = aggregate(lots, "count", group_by_column="price").collect()
    assert out == [
        Row(price=None, count=1),
        Row(price=decimal.Decimal("10.50"), count=1),
        Row(price=decimal.Decimal("20.00"), count=2),
    ]


@pytest.mark.parametrize(
    "args, kwargs",
    [
        (("median",), {}),
        (("sum",), {}),
        (("sum",), {"agg_column": "gone"}),
        (("count",), {"group_by_column": "gone"}),
    ],
)
def test_bad_aggregates(lots, args, kwargs):
    with pytest.raises(ValueError):
        aggregate(lots, *args, **kwargs)


def test_group_named_like_the_metric(lots):
    renamed = lots.withColumnRenamed("id", "count")
    with pytest.raises(ValueError, match="name of the metric"):
        aggregate(renamed, "count", group_by_column="count")


def test_coerced_output(spark):
    when = datetime.datetime(2026, 5, 1, 9)
    row = (bytearray(b"ok\xff"), when, when.replace(microsecond=7), when.date(), decimal.Decimal("1.25"), None, 3)
    df = spark.createDataFrame(
        [row], "b binary, t timestamp_ntz, u timestamp_ntz, d date, m decimal(18,2), n string, i int"
    )
    assert tuple(coerce_output(df).first()) == (
        "ok�", "2026-05-01T09:00:00", "2026-05-01T09:00:00.000007", "2026-05-01", 1.25, None, 3
    )


def test_envelope(lots):
    assert tuple(envelope(query(lots, limit=2), 2).first()) == (2, True)
    assert tuple(envelope(query(lots, limit=9), 9).first()) == (4, False)


def test_export(spark, lots, tmp_path):
    path = str(tmp_path / "rows")
    export_rows(lots, path, ["price", "unknown"])
    back = spark.read.json(path)
    assert sorted(back.columns) == ["at", "day", "id", "name"]
    assert back.where("id = 1").first()["at"] == "2026-01-01T12:00:00"
