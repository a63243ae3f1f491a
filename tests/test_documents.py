"""Golden tests for flattening JSON and XML documents held in columns."""

from __future__ import annotations

import json

import pytest

from weir.plans import documents
from weir.plans.documents import flat_foods, flat_pets
from weir.sinks import rejects

PHOTO = "https://learnwebcode.github.io/json-example/images/"

# The three pets of the sample document and their flat rows.
PETS_DOC = {
    "pets": [
        {"name": "Purrsloud", "species": "Cat", "favFoods": ["wet food", "dry food", "<strong>any</strong> food"],
         "birthYear": 2016, "photo": PHOTO + "cat-2.jpg"},
        {"name": "Barksalot", "species": "Dog", "birthYear": 2008, "photo": PHOTO + "dog-1.jpg"},
        {"name": "Meowsalot", "species": "Cat", "favFoods": ["tuna", "catnip", "celery"], "birthYear": 2012,
         "photo": PHOTO + "cat-1.jpg"},
    ]
}


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_flat_pets_golden(spark):
    raw = spark.createDataFrame([(json.dumps(PETS_DOC, indent=2),)], "json_data string")
    got = {r.name: r for r in flat_pets(raw).collect()}
    assert set(got) == {"Purrsloud", "Barksalot", "Meowsalot"}
    assert json.loads(got["Purrsloud"].fav_foods) == ["wet food", "dry food", "<strong>any</strong> food"]
    assert got["Barksalot"].fav_foods is None
    assert json.loads(got["Meowsalot"].fav_foods) == ["tuna", "catnip", "celery"]
    assert (got["Purrsloud"].birth_year, got["Barksalot"].birth_year, got["Meowsalot"].birth_year) == (2016, 2008, 2012)
    assert got["Barksalot"].photo == PHOTO + "dog-1.jpg"
    assert got["Purrsloud"].species == "Cat"


def test_flat_pets_edges(spark):
    docs = [
        json.dumps({"other": 1}),  # no pets key: no row
        json.dumps({"pets": [{"name": "Empty", "favFoods": [], "birthYear": None}]}),
        json.dumps({"pets": [{"name": "Crème", "favFoods": ["pâté", "smørrebrød"], "birthYear": 2020}]}),
        json.dumps({"pets": []}),
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "json_data string")
    got = {r.name: r for r in flat_pets(raw).collect()}
    assert set(got) == {"Empty", "Crème"}
    assert got["Empty"].fav_foods is None and got["Empty"].birth_year is None
    assert json.loads(got["Crème"].fav_foods) == ["pâté", "smørrebrød"]
    assert got["Crème"].birth_year == 2020


# The ten foods of the sample nutrition document, as
# (name, mfr, serving, units, cal_total, cal_fat, total-fat, saturated-fat,
#  cholesterol, sodium, carb, fiber, protein, vit a, vit c, ca, fe).
FOODS = [
    ("Avocado Dip", "Sunnydale", "29", "g", "110", "100", "11", "3", "5", "210", "2", "0", "1", "0", "0", "0", "0"),
    ("Bagels, New York Style ", "Thompson", "104", "g", "300", "35", "4", "1", "0", "510", "54", "3", "11", "0", "0", "8", "20"),
    ("Beef Frankfurter, Quarter Pound ", "Armitage", "115", "g", "370", "290", "32", "15", "65", "1100", "8", "0", "13", "0", "2", "1", "6"),
    ("Chicken Pot Pie", "Lakeson", "198", "g", "410", "200", "22", "9", "25", "810", "42", "2", "10", "20", "2", "2", "10"),
    ("Cole Slaw", "Fresh Quick", "1.5", "cup", "20", "0", "0", "0", "0", "15", "5", "2", "1", "30", "45", "4", "2"),
    ("Eggs", "Goodpath", "50", "g", "70", "40", "4.5", "1.5", "215", "65", "1", "0", "6", "6", "0", "2", "4"),
    ("Hazelnut Spread", "Ferreira", "2", "tbsp", "200", "90", "10", "2", "0", "20", "23", "2", "3", "0", "0", "6", "4"),
    ("Potato Chips", "Lees", "28", "g", "150", "90", "10", "3", "0", "180", "15", "1", "2", "0", "10", "0", "0"),
    ("Soy Patties, Grilled", "Gardenproducts", "96", "g", "160", "45", "5", "0", "0", "420", "10", "4", "9", "0", "0", "0", "0"),
    ("Truffles, Dark Chocolate", "Lyndon's", "39", "g", "220", "170", "19", "14", "25", "10", "16", "1", "1", "0", "0", "0", "0"),
]


def _food_xml(f, vitamins=True, minerals=True, name_xml=None):
    name, mfr, serving, units, tot, fat, tf, sf, ch, na, carb, fib, pro, va, vc, ca, fe = f
    parts = [
        "<food>",
        name_xml if name_xml is not None else f"\t<name>{name}</name>",
        f"\t<mfr>{mfr}</mfr>",
        f'\t<serving units="{units}">{serving}</serving>',
        f'\t<calories total="{tot}" fat="{fat}"/>',
        f"\t<total-fat>{tf}</total-fat>",
        f"\t<saturated-fat>{sf}</saturated-fat>",
        f"\t<cholesterol>{ch}</cholesterol>",
        f"\t<sodium>{na}</sodium>",
        f"\t<carb>{carb}</carb>",
        f"\t<fiber>{fib}</fiber>",
        f"\t<protein>{pro}</protein>",
    ]
    if vitamins:
        parts += ["\t<vitamins>", f"\t\t<a>{va}</a>", f"\t\t<c>{vc}</c>", "\t</vitamins>"]
    if minerals:
        parts += ["\t<minerals>", f"\t\t<ca>{ca}</ca>", f"\t\t<fe>{fe}</fe>", "\t</minerals>"]
    return "\n".join(parts + ["</food>"])


def _doc(foods_xml):
    head = '<?xml version="1.0"?>\n<nutrition>\n<daily-values>\n\t<total-fat units="g">65</total-fat>\n</daily-values>\n'
    return head + "\n".join(foods_xml) + "\n</nutrition>"


def test_flat_foods_golden(spark):
    raw = spark.createDataFrame([(_doc([_food_xml(f) for f in FOODS]),)], "xml_data string")
    got = _rows(flat_foods(raw))
    want = sorted(
        (n, m, s, int(t), int(fa), tf, sf, ch, na, carb, fib, pro, va, vc, ca, fe)
        for (n, m, s, _u, t, fa, tf, sf, ch, na, carb, fib, pro, va, vc, ca, fe) in FOODS
    )
    assert got == want
    # whitespace of text nodes is kept
    assert "Bagels, New York Style " in [r[0] for r in got]


def test_flat_foods_edges(spark):
    base = FOODS[0]
    no_fat = base[:5] + ("",) + base[6:]
    docs = [
        _doc([_food_xml(base, vitamins=False, minerals=False)]),
        _doc([_food_xml(no_fat)]),
        _doc([_food_xml(base, name_xml="\t<name/>")]),
        '<?xml version="1.0"?>\n<nutrition>\n<daily-values/>\n</nutrition>',  # no food
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "xml_data string")
    rows = flat_foods(raw).collect()
    assert len(rows) == 3
    missing = [r for r in rows if r.food_name == "Avocado Dip" and r.vitamin_a == "0" and r.iron == "0" and r.calories_fat == 100]
    assert missing
    assert [r.calories_fat for r in rows if r.calories_fat is None] == [None]
    assert [r.food_name for r in rows if r.food_name is None] == [None]


def test_foods_at_any_depth_keep_their_text(spark):
    doc = (
        '<?xml version="1.0"?>\n<!-- <food><name>no</name></food> --><n><food><name>a </name><mfr>007</mfr>'
        '<serving units="g">3.50</serving><calories total="010" fat=""/><vitamins><a>1.0</a></vitamins>'
        "<food><name><![CDATA[<x> 1.0]]></name><mfr>x &amp; y</mfr></food></food>"
        "<g><food><name>b</name></food><h><food><name>c</name></food><food/><food><name>1</name><name>2</name></food></h></g></n>"
    )
    df = spark.createDataFrame([(doc,), ("<food><name>root</name></food>",), (None,), ("<n/>",)], "xml_data string")
    got = sorted((r.food_name or "", r.manufacturer, r.serving_size, r.calories_total, r.calories_fat, r.vitamin_a) for r in documents.flat_foods(df).collect())
    assert got == sorted([
        ("a ", "007", "3.50", 10, None, "1.0"), ("<x> 1.0", "x & y", None, None, None, "0"), ("b", None, None, None, None, "0"),
        ("c", None, None, None, None, "0"), ("", None, None, None, None, "0"), ("1", None, None, None, None, "0"),
        ("root", None, None, None, None, "0")])


BROKEN_XML = ["<n><food><name>z</name></n>", "plain", "<a/><b/>", "", "<a/><a/>"]
BROKEN_JSON = ['{"pets":[{"na', "", '{"pets":{"name":"a"}}']


@pytest.mark.parametrize("text", BROKEN_XML)
def test_malformed_xml_fails_the_run(spark, text):
    with pytest.raises(Exception, match="malformed"):
        documents.flat_foods(spark.createDataFrame([(text,)], "xml_data string")).collect()


def test_malformed_documents_are_counted_rejects(spark, workdir):
    foods = spark.createDataFrame([(t,) for t in [*BROKEN_XML, "<n><food/></n>", None]], "xml_data string")
    pets = spark.createDataFrame([(t,) for t in [*BROKEN_JSON, '{"pets":[{"name":"a"},{"name":"b"}]}', "[1]", None]], "json_data string")
    for load, df, rows, broken in ((documents.load_foods, foods, 1, BROKEN_XML), (documents.load_pets, pets, 2, BROKEN_JSON)):
        root = f"{workdir}/{load.__name__}"
        for n in (1, 2):  # rows are appended again, rejects of the same load are not
            assert load(df, f"{root}/rows", f"{root}/rejects", "run-1") == {"loaded": rows, "rejected": len(broken)}
            assert spark.read.parquet(f"{root}/rows").count() == n * rows
            refused = rejects.read(spark, f"{root}/rejects").collect()
            assert sorted(r.record for r in refused) == sorted(broken) and {r.reason for r in refused} == {"malformed"}
