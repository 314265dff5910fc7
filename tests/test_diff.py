import random
from xml.etree import ElementTree as ET

from setforge.plans.diff import diff_attributes

SCHEMA = "pair_id long, xml string, xml2 string"


def match(a, b):
    return a.tag == b.tag and a.attrib == b.attrib and len(a) == len(b) and all(any(match(c, d) for d in b) for c in a)


def test_known_pairs(spark):
    rows = [
        (0, '<box><lid size="2" tone="red"/></box>', '<box><lid size="2" tone="blue"/></box>'),
        (1, None, "<a/>"),
        (2, "<r><a/><a/></r>", "<r><a/><b/></r>"),
        (3, "<r><a/><b/></r>", "<r><a/><a/></r>"),
        (4, '<a x="1"/>', '<a x="1" y="2"/>'),
        (6, "<a><b>", "<a><b/></a>"),
        (5, '<x:a xmlns:x="u" k="1"/>', '<a k="1">text</a>'),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.pair_id: (r.result, r.changed) for r in diff_attributes(df).collect()} == {
        0: (1, "tone"), 1: (1, ""), 2: (0, ""), 3: (1, ""), 4: (1, ""), 5: (0, ""), 6: (1, ""),
    }
    assert {r.pair_id: r.changed for r in diff_attributes(df, "full").collect()}[4] == "y"


def test_equals_recursive_comparison(spark):
    rnd = random.Random(11)

    def tree(depth=0):
        e = ET.Element(rnd.choice("ab"), {n: rnd.choice("12") for n in "xy" if rnd.random() < 0.3})
        for _ in range(rnd.choice([0, 1, 2, 3]) if depth < 3 else 0):
            e.append(tree(depth + 1))
        return e

    def doubled(e):
        e = ET.fromstring(ET.tostring(e))
        for x in e.iter():
            if len(x) > 1 and rnd.random() < 0.5:
                x[rnd.randrange(len(x))] = ET.fromstring(ET.tostring(x[rnd.randrange(len(x))]))
        return e

    rows, expected = [], {}
    for i in range(150):
        a = tree()
        b = doubled(a)
        if rnd.random() < 0.5:
            a, b = b, a
        rows.append((i, ET.tostring(a).decode(), ET.tostring(b).decode()))
        expected[i] = 0 if match(a, b) else 1
    assert {r.pair_id: r.result for r in diff_attributes(spark.createDataFrame(rows, SCHEMA)).collect()} == expected


def test_all_equal_and_all_missing(spark):
    assert diff_attributes(spark.createDataFrame([(1, "<a/>", "<a/>")], SCHEMA)).first().result == 0
    assert diff_attributes(spark.createDataFrame([(1, None, None)], SCHEMA)).first().result == 1
