"""One JSON document cut into splits of any size gives its records, whole and once."""

from __future__ import annotations

import json

import pytest

from strata.sources import jsonsplit, readers
from tests.conftest import rows

ODD = ['a],[b', '}, {"x": 1', '\\" [', 'quote " in', "back\\", "\\\\", '"records": [', "é🎉\n\t", "", "plain", "],", "}]}"]


def documents():
    cells = [[i, ODD[i % len(ODD)], None, [1, [2, {"k": "]"}]], 2.5, True] for i in range(60)]
    names = [f"c{k}" for k in range(6)]
    fields = [{"id": n, "type": "text"} for n in names]
    objects = [dict(zip(names, c)) | ({"only": "x"} if c[0] % 9 == 0 else {}) for c in cells]
    return {
        "dump": {"help": "a ] b", "fields": fields, "records": cells, "total": 60},
        "late": {"records": cells, "fields": fields, "more": {"records": 3}},
        "objects": {"records": objects, "links": {"next": "]}"}},
        "empty": {"fields": fields, "records": []},
    }


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("name", ["dump", "late", "objects", "empty"])
def test_cuts_at_any_place(name, indent):
    """Without Spark: splits that end after every n-th token, for all small n."""
    end = "]" if name in ("dump", "late") else "}"
    document = documents()[name]
    text = json.dumps(document, indent=indent, ensure_ascii=False)
    tokens = [t + end for t in text.split(end)]
    for size in [1, 2, 3, 7, 20, len(tokens)]:
        splits = [(k, tokens[k : k + size]) for k in range(0, len(tokens), size)]
        # an array before the records begins in the split that they begin in
        first = next(n for n, (_, s) in enumerate(splits) if any(jsonsplit._OPENING.search(t) for t in s))
        splits = [(0, sum((s for _, s in splits[: first + 1]), []))] + splits[first + 1 :]
        state = jsonsplit.begins([(k, jsonsplit._figures(iter(s))) for k, s in splits])
        pieces = [(k, kind, text) for k, s in splits for kind, text in jsonsplit.cut(iter(s), *state[k])]
        crossing, outer = jsonsplit.stitched(sorted((p for p in pieces if p[1] != jsonsplit.RECORD), key=lambda p: p[:2]))
        found = [json.loads(t) for _, kind, t in pieces if kind == jsonsplit.RECORD] + [json.loads(t) for t in crossing]
        order = (lambda r: r[0]) if name != "objects" else (lambda r: r["c0"])
        assert sorted(found, key=order) == document["records"]
        head, _ = json.JSONDecoder().raw_decode(outer)
        assert head == document | {"records": []}


@pytest.mark.parametrize("name", ["dump", "late", "objects"])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, name):
    document = documents()[name]
    path = str(tmp_path / "d.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(document, file, ensure_ascii=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.option("lineSep", "]").text(path).rdd.getNumPartitions() > 3
        got = readers.read_json(spark, path)
        if name == "objects":
            assert rows(got, "c0", "c1", "c4", "only") == sorted(
                ((r["c0"], r["c1"], r["c4"], r.get("only")) for r in document["records"]), key=lambda r: str(r[0])
            )
        else:
            want = [(str(r[0]), r[1], None, "2.5", "true") for r in document["records"]]
            assert rows(got, "c0", "c1", "c2", "c4", "c5") == sorted(want, key=lambda r: r[0])
            nested = {json.dumps(json.loads(r["c3"])) for r in got.collect()}
            assert nested == {json.dumps([1, [2, {"k": "]"}]])}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", ["{}", "", "[1, 2]", '{"other": [1]}', '{"records": [[1], [2'])
def test_documents_without_records_are_refused(spark, tmp_path, text):
    path = tmp_path / "d.json"
    path.write_text(text)
    with pytest.raises(ValueError):
        readers.read_json(spark, str(path)).collect()
