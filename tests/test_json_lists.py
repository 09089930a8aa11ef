"""JSON lists with broken objects."""

import json

import pytest

from newsfeat.functions.json_lists import split_objects
from newsfeat.sources import readers as R


def article(i, text="text"):
    return json.dumps({"scrollid": f"g{i}", "tn2": ["a", "b"], "subheadline": f"T{i}", "data": text})


BROKEN = ['{"scrollid": "x", "data": ', '{"scrollid": "x" "data": "y"}', '{"scrollid": "x", "data": "no end}',
          '{"a": [{"b": 1}, {"c": 2}] oops}', "oops", '{"scrollid": "x"}}']


@pytest.mark.parametrize("bad", BROKEN)
@pytest.mark.parametrize("place", [0, 1, 2, 3])
def test_a_broken_object_costs_itself(bad, place):
    good = [article(1, 'says "}, {" and [1], \\ more'), article(2, "two\nlines"), article(3)]
    items = good[:place] + [bad] + good[place:]
    found = list(split_objects(" [ " + ", \n".join(items) + " ]\n", list(R.JSON_FIELDS.values())))
    assert [x for x in found if x in good] == good and len(found) == 4


def test_cut_and_empty_lists():
    good = [article(i) for i in range(3)]
    cut = "[" + ",".join(good)
    assert list(split_objects(cut, ["scrollid"])) == good
    assert list(split_objects(cut[:-5], ["scrollid"])) == [*good[:2], good[2][:-5]]
    assert list(split_objects("[]", ["scrollid"])) == list(split_objects("[ , ]", ["scrollid"])) == []
    assert list(split_objects("[1, null, " + good[0] + "]", ["scrollid"])) == ["1", "null", good[0]]


def test_texts_and_files(spark, tmp_path):
    text = "[" + article(1) + ", {broken, " + article(2, "x}, {y") + "]"
    df = spark.createDataFrame([(text, 7), (article(3), 8), ("{", 9), ("[" + article(4) + "]", 10), (None, 11)], "json string, n int")
    rows = [(r.n, r.guid, r.malformed) for r in R.parse_json(df).collect()]
    assert sorted((n, g or "", m) for n, g, m in rows) == [
        (7, "", True), (7, "g1", False), (7, "g2", False), (8, "g3", False), (9, "", True), (10, "g4", False), (11, "", True)]
    for i, r in enumerate(df.where("json IS NOT NULL").collect()):
        (tmp_path / f"f{i}.json").write_text(r.json)
    scanned = R.scan_json(spark, str(tmp_path))
    assert sorted(r["guid"] for r in R.read_json(spark, str(tmp_path)).collect()) == ["g1", "g2", "g3", "g4"]
    assert tuple(R.reject_counts(scanned).first()) == (6, 2)
    bulk = R.read_json_folder(spark, str(tmp_path), ["scrollid", "data", "i2"])
    assert sorted((r["fileID"], r["scrollid"], r["data"], r["i2"]) for r in bulk.collect()) == [
        ("f0", "g1", "text", "NULL"), ("f0", "g2", "x}, {y", "NULL"), ("f1", "g3", "text", "NULL"), ("f3", "g4", "text", "NULL")]
