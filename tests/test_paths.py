import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harspan.functions.paths import is_dynamic, named_template, plain_template

U = "12345678-1234-1234-1234-1234567890ab"
CASES = [
    ("/users/123/orders/7", "/users/{id}/orders/{id}", "/users/{userId}/orders/{orderId}"),
    (f"/users/{U}", "/users/{uuid}", "/users/{userId}"),
    ("/d/2024-01-01", "/d/{id}-01-01", "/d/2024-01-01"),
    ("/x/7ab", "/x/{id}ab", "/x/7ab"),
    ("/address/5", "/address/{id}", "/address/{addreId}"),
    ("/users/1/2/3", "/users/{id}/{id}/{id}", "/users/{userId}/{userId2}/{userId3}"),
    ("/5", "/{id}", "/{param1}"),
    ("/", "/", "/"),
    ("", "", "/"),
    ("/s/1", "/s/{id}", "/s/{param2}"),
    ("/a/0123456789abcdef01234567", "/a/{id}abcdef01234567", "/a/{aId}"),
    ("/t/ab12cd34", "/t/ab12cd34", "/t/{tId}"),
]


def test_templates(spark):
    rows = spark.createDataFrame([(c[0],) for c in CASES], "p string").select("p", plain_template(F.col("p")).alias("a"), named_template(F.col("p")).alias("b")).collect()
    for row, (path, plain, named) in zip(rows, CASES):
        assert row.a == plain, path
        assert row.b.template == named, path
    assert rows[5].b.params == {"userId": "1", "userId2": "2", "userId3": "3"}


def test_dynamic_segments(spark):
    words = ["", "12", U, "0123456789abcdef01234567", "abcdefgh", "12345678x", "a1-b2_c3", "2024-01-01", None]
    rows = spark.createDataFrame([(w,) for w in words], "s string").select(is_dynamic(F.col("s")).alias("d")).collect()
    assert [r.d for r in rows] == [False, True, True, True, False, True, True, False, False]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(["users", "1", "77", "s", "a1b2c3d4", "x"]), min_size=1, max_size=6))
def test_template_of_a_template_is_itself(spark, parts):
    path = "/" + "/".join(parts)
    once = spark.range(1).select(plain_template(F.lit(path)).alias("t")).first().t
    assert spark.range(1).select(plain_template(F.lit(once)).alias("t")).first().t == once


@pytest.mark.parametrize("path", [None])
def test_null_path(spark, path):
    assert spark.range(1).select(named_template(F.lit(path).cast("string")).alias("t")).first().t is None
