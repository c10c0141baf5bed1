import pytest
from hypothesis import given
from hypothesis import strategies as st

from harspan.operators.packed_values import Segmenter, load_dictionary, near, unpack_values

KNOWN = ["General Trading", "Precious Stones, Pearls and Diamonds Cutting", "Import/Export Brokerage", "Boats; Berthing and Storage", 'Printing of "Ready" Packaging',
         "Cold Chain - Storage and Transport", "Research | Natural Sciences", "Tea Trading", "القوارب؛ الرسو والتخزين", "تجارة الشاي"]
SEGMENTER = Segmenter(KNOWN)


@pytest.mark.parametrize(
    "text,items",
    [
        (None, []),
        ("  ", []),
        ("[]", []),
        (" ; , ", []),
        ("GENERAL TRADING", ["GENERAL TRADING"]),
        ("Tea Trading, Precious Stones, Pearls and Diamonds Cutting", ["Tea Trading", "Precious Stones, Pearls and Diamonds Cutting"]),
        ("Tea Trading/Import/Export Brokerage", ["Tea Trading", "Import/Export Brokerage"]),
        ("Boats; Berthing and Storage; Tea  Trading;", ["Boats; Berthing and Storage", "Tea  Trading"]),
        ("Boats; Berthing and Strage - Toys Repair", ["Boats; Berthing and Strage", "Toys Repair"]),
        ("Tea Trading - Cold Chain - Storage and Transport -", ["Tea Trading", "Cold Chain - Storage and Transport"]),
        ("Research | Natural Sciences | Own Thing", ["Research | Natural Sciences", "Own Thing"]),
        ("1. Tea Trading\n2. Own Thing", ["Tea Trading", "Own Thing"]),
        ("(1) Tea Trading<br>(2) Own Thing<BR />", ["Tea Trading", "Own Thing"]),
        ('"Tea Trading";"Own Thing"; "General Trading"', ["Tea Trading", "Own Thing", "General Trading"]),
        ('"Printing of ""Ready"" Packaging", Tea Trading', ['Printing of "Ready" Packaging', "Tea Trading"]),
        ('["Printing of \\"Ready\\" Packaging", "Tea Trading", ""]', ['Printing of "Ready" Packaging', "Tea Trading"]),
        ("['Tea Trading', 'Tea Trading']", ["Tea Trading", "Tea Trading"]),
        ("القوارب؛ الرسو والتخزين؛ تجارة الشاي، شيء", ["القوارب؛ الرسو والتخزين", "تجارة الشاي", "شيء"]),
        ("[unclosed, Tea Trading", ["[unclosed", "Tea Trading"]),
    ],
)
def test_items(text, items):
    assert SEGMENTER.items(text) == items


@given(st.lists(st.sampled_from(KNOWN[:8]), min_size=1, max_size=6), st.sampled_from(["; ", ", ", " | ", "\n", "<br>", " • ", "\t", " - "]))
def test_round_trip_of_known_values(values, delimiter):
    assert SEGMENTER.items(delimiter.join(values)) == values


@given(st.text(max_size=60))
def test_any_text_is_divided_without_failing(text):
    items = SEGMENTER.items(text)
    assert all(i == i.strip() and i for i in items)


def test_near():
    assert near("abcd", "abdc", 1) and near("abcd", "abxcd", 1) and not near("abcd", "wxyz", 2)


def test_unpack(spark):
    rows = [(1, "Tea Trading; X", None, 1), (2, None, "", 2), (None, "Y", "Z", 3), (4, "long, " * 5000, "q", 4), (1, "Tea Trading; X", None, 5)]
    df = spark.createDataFrame(rows, "rec_id long, a string, b string, item_text int")
    known = load_dictionary(spark.createDataFrame([("Tea Trading", None)], "name_en string, name_ar string"), "name_en", "name_ar")
    out = unpack_values(df, "rec_id", ["a", "b"], known).collect()
    assert sorted((r.field_name, r.item_pos, r.item_text) for r in out if r.rec_id == 1) == [("a", 1, "Tea Trading")] * 2 + [("a", 2, "X")] * 2
    assert len([r for r in out if r.rec_id is None]) == 2 and len([r for r in out if r.rec_id == 4]) == 5001
    assert unpack_values(df.where("false"), "rec_id", ["a"], []).count() == 0


def test_delimiter_far_before_a_known_value():
    value = "Precious Stones, Pearls and Diamonds Cutting"
    assert SEGMENTER.items("Own Thing;" + " " * 40 + value) == ["Own Thing", value]
    assert SEGMENTER.items("Own Thing;" + " " * 40 + "(2)" + " " * 30 + '"' + value + '"') [-1].strip('"') == value
