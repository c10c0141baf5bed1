from harspan.llm import addresses
from harspan.llm.address_parts import gapped, is_placeholder, read_parts, sounds

SCHEMA = "rec_id long, licAddress string, licArabicAddress string, premises string"


def test_parts():
    p = read_parts("Unit No: 1918, Gomfedhus House 2, Caravan Street, Saffron Park, Port Merwan, PO Box 94564")
    assert (p.unit, p.number, p.box, p.street, p.names) == ("1918", "2", "94564", "caravan", [sounds("gomfedhus")])
    p = read_parts("gomfedhus hse no. 2 , floor 19 , #19-18 , pt. merwan")
    assert (p.unit, p.number, p.names) == ("1918", "2", [sounds("gomfedhus")])
    p = read_parts("دار غومفيدهوس ٢،رقم ١٩١٨،شارع القافلة،ص.ب ٩٤٥٦٤")
    assert (p.unit, p.number, p.box, p.names) == ("1918", "2", "94564", [sounds("gomfedhus")])
    p = read_parts("Ofc 2407 Flr 24 Yewnajmiq Business Park Quarry Ave Wadi Sulam")
    assert (p.unit, p.names) == ("2407", [sounds("yewnajmiq")])
    p = read_parts("Office 2919 Fl. 29 Honbumlek W. Sulam")
    assert p.unit == "2919" and not p.names and sounds("honbumlek") in p.maybe
    assert read_parts("N/A") is None and read_parts(" <br> ") is None and read_parts(None) is None
    assert is_placeholder("-") and not is_placeholder("x y")


def test_one_edit_shares_a_gapped_form():
    word = "gomfedhus"
    for other in ("gonfedhus", "gmofedhus", "gomfedhs", "gommfedhus"):
        assert set(gapped(word)) & set(gapped(other))


def test_same_premises(spark):
    tower = [(i, f"Unit {i}, Qisdunhus Tower 1, Ivory Road, Qasrin City", None, "clash") for i in range(100, 130)]
    rows = [
        (1, "Unit No: 2710, Qisdunhus Tower 1, Ivory Road, Old Customs, PO Box 5118", None, None),
        (2, "#27-10<br/>qsidunhus twr one<br/>Old Customs", None, None),
        (3, None, "برج قيسدونهوس ١، مكتب ٢٧١٠", None),
        (4, "Unit 2710, Qisdunhus Tower 2, Ivory Road", None, None),
        (5, "Rm 2711, Qisdunhus Tower 1", None, None),
        (6, "Unit No: 2710, Qisdunhus Tower 1, Ivory Road, Old Customs, PO Box 5118", None, None),
        (7, "N/A", "", None),
        (8, None, None, None),
        (9, "somewhere", None, None),
        (10, "somewhere", None, None),
        (11, "Qisdunhus, Off. 2710, Ivory Rd " + "long " * 3000, "مكتب ٢٧١٠", None),
        (None, "Unit 2710, Qisdunhus Tower 1", None, None),
    ]
    df = spark.createDataFrame(rows + tower, SCHEMA)
    members = addresses.same_premises(df)
    by = {}
    for r in members.collect():
        by.setdefault(r.premises, set()).add(r.rec_id)
    groups = [g for g in by.values() if len(g) > 1]
    # row 11 tells no building number, and both towers have such a unit
    assert sorted(map(sorted, groups)) == [[1, 2, 3, 6], [9, 10]]
    pairs = {(r.rec_a, r.rec_b) for r in addresses.premises_pairs(members).collect()}
    assert {(1, 2), (1, 3), (2, 3), (2, 6), (3, 6)} <= pairs and (1, 6) not in pairs and (9, 10) not in pairs
    assert addresses.premises_pairs(addresses.same_premises(df.where("false"))).count() == 0


def test_unread_addresses_compare_by_their_whole_wording_in_both_fields(spark):
    long = "behind the old market " * 30
    texts = [(long + "north", None), (long + "south", None), (long.upper() + "  north", "N/A"), ("N/A", "بجانب السوق"), ("N/A", "خلف المسجد")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(texts)], "rec_id long, licAddress string, licArabicAddress string")
    by = {r.rec_id: r.premises for r in addresses.same_premises(df).collect()}
    assert by[0] == by[2] and len(set(by.values())) == 4 and len(by) == 5


def test_dash_between_parts_joins_no_numbers():
    p = read_parts("Woftesyuk Center 2 - 315 - Harbour Heights - Pt. Merwan")
    assert (p.unit, p.number, p.names) == ("315", "2", [sounds("woftesyuk")])


def containment_rows():
    filler = [(f"Unit {i}, Gomfedhus House {1 + i % 2}, Amber Street, PO Box 7777", None) for i in range(200, 240)]
    filler += [(f"Unit {i}, Rittiyhus Plaza, Ivory Road, PO Box 8888", None) for i in range(200, 240)]
    cases = {
        "full": "Unit 301, Gomfedhus House 1, Amber Street, Lake Quarter, PO Box 7777",
        "no number": "Unit 301, Gomfedhus House, Amber Street",
        "no building": "Unit 301, PO Box 7777",
        "misspelt twice": "Unit 301, Gmofedhsu House 1, Amber Street, PO Box 7777",
        "other plaza": "Unit 301, Rittiyhus Plaza, Ivory Road, PO Box 8888",
        "by street": "Office 301, Ivory Road",
        "one": "Unit 302, Gomfedhus House 1, Amber Street",
        "two": "Unit 302, Gomfedhus House 2, Amber Street",
        "one or two": "Unit 302, Gomfedhus House, PO Box 7777",
        "either": "Unit 302, Amber Street",
        "either again": "Office 302; Amber Street",
        "nothing told": "Unit 303",
        "nothing told, otherwise": "Office 303 upstairs",
    }
    return cases, [(v, None) for v in cases.values()] + filler


def test_missing_parts_contradict_nothing_and_the_join_links(spark, monkeypatch):
    cases, texts = containment_rows()
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(texts)], "rec_id long, licAddress string, licArabicAddress string")
    names = list(cases)

    def groups():
        by = {}
        for r in addresses.same_premises(df).collect():
            if r.rec_id < len(names):
                by.setdefault(r.premises, []).append(r.rec_id)
        return sorted(sorted(names[i] for i in g) for g in by.values())

    assert groups() == [
        ["by street", "other plaza"],
        ["either", "either again"],
        ["full", "misspelt twice", "no building", "no number"],
        ["nothing told"],
        ["nothing told, otherwise"],
        ["one"],
        ["one or two"],
        ["two"],
    ]
    # without the join nothing but equal parts is linked
    contained = addresses.contained
    monkeypatch.setattr(addresses, "contained", lambda whole: contained(whole).where("false"))
    assert [g for g in groups() if len(g) > 1] == [["either", "either again"]]


def test_crowded_place_and_clashing_columns(spark):
    streets = ["Amber", "Ivory", "Jasmine", "Marble"]
    rows = [(i, f"Unit 9, Gomfedhus House 1, {streets[i % 4]} Street, Quarter{i % 50}" + (", PO Box 5" if i % 3 else ""), None, "x", 1) for i in range(400)]
    df = spark.createDataFrame(rows, "rec_id long, licAddress string, licArabicAddress string, premises string, tokens int")
    assert len({r.premises for r in addresses.same_premises(df).collect()}) == 1
