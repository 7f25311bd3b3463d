"""Edge cases: empty sets, nulls, ties, odd headings, chains of similar names, braces in strings."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import jsonx
from quillgraph.functions import text as tx
from quillgraph.operators import chunk, dedup, extract, graph, model, normalize, relate, render, retrieve


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("line,yes", [("1.Intro", True), ("1.2 Foo", True), ("IV.T", True), ("Cap.3", True), ("Chapter 1", True), ("1. Intro", False), ("IV. T", False), ("Cap. 3", False), ("Capitolul 2", False), ("chapters", False)])
def test_headings(spark, line, yes):
    assert one(spark, tx.is_heading, line) is yes


def test_text(spark):
    assert one(spark, tx.snake, "  Modul de Atenție -- nou ") == "modul_de_atenție_nou"
    assert one(spark, tx.key, "Atenție__X ") == "aten_ie_x"
    assert one(spark, tx.transliterate, "Ștefan straße “ok”…") == 'Stefan strasse "ok"...'
    assert one(spark, tx.collapse_space, "a\n\n\n\nb  \t c\td") == "a\n\nb c\td"
    assert one(spark, tx.sentences, "A b. C!  D") == ["A b.", "C!", "D"]
    assert one(spark, tx.language, "romanian, but English") == "en"
    assert one(spark, tx.language, "limba romana") == "ro"
    assert one(spark, tx.first_line, "   a b\r\nc") == "a b"
    assert one(spark, tx.key_tokens, "") == [""]
    assert one(spark, tx.io_tokens, "") == []
    assert one(spark, tx.snake, None) is None


def test_json(spark):
    assert one(spark, jsonx.block, 'text {"a": {}} tail') == '{"a": {}}'
    assert one(spark, jsonx.block, 'say {"a": "}"} x') == '{"a": "}'
    assert one(spark, jsonx.block, '{"a": {') is None
    assert one(spark, jsonx.block, "none }") is None
    assert spark.sql("select 'null' x").select(jsonx.parsed(F.col("x")).isNull()).first()[0]
    rng = random.Random(3)
    texts = ["".join(rng.choice("{}a\" ") for _ in range(rng.randrange(30))) for _ in range(400)]

    def plain(t):
        a = t.find("{")
        depth = 0
        for i in range(a, len(t)) if a >= 0 else ():
            depth += (t[i] == "{") - (t[i] == "}")
            if depth == 0:
                return t[a : i + 1]
        return None

    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", jsonx.block(F.col("t"))).collect()
    assert {r[0]: r[1] for r in got} == {i: plain(t) for i, t in enumerate(texts)}


def test_chunks_and_sections(spark):
    docs = spark.createDataFrame([(1, " ".join(map(str, range(8)))), (2, ""), (3, None), (4, "a b")], "doc_id long, text string")
    got = {(r["doc_id"], r["chunk_idx"]): r["text"] for r in chunk.token_windows(docs, 4, 1).collect()}
    assert got == {(1, 0): "0 1 2 3", (1, 1): "3 4 5 6", (1, 2): "6 7", (4, 0): "a b"}
    # lines and paragraphs stay, so that a heading is a line of its own
    book = spark.createDataFrame([(1, "Chapter 1\nThe gate is a module that opens.\n\nSecond  para here. \n")], "doc_id long, text string")
    whole = chunk.token_windows(book)
    assert [r["text"] for r in whole.collect()] == ["Chapter 1\nThe gate is a module that opens.\n\nSecond  para here."]
    assert [r["title"] for r in chunk.sections(whole).collect()] == ["Chapter 1"]
    rows = [(1, 0, "Chapter 1\nx"), (1, 1, "y"), (2, 0, "a"), (2, 1, "b"), (2, 2, "Section A"), (3, 0, "Appendix z"), (3, 1, "u"), (3, 2, "v")]
    s = chunk.sections(spark.createDataFrame(rows, "doc_id long, chunk_idx int, text string"))
    assert sorted((r["doc_id"], r["section_ord"], r["title"], r["chunk_indices"]) for r in s.collect()) == [(1, 0, "Chapter 1", [0, 1]), (2, 0, "Introduction", [0, 1]), (2, 1, "Section A", [2]), (3, 0, "Appendix z", [0, 1, 2])]
    assert sorted((r["doc_id"], r["section_ord"], r["chunk_idx"]) for r in chunk.representatives(s).collect()) == [(1, 0, 0), (2, 0, 0), (2, 1, 2), (3, 0, 0), (3, 0, 1), (3, 0, 2)]


def test_recursive_chunks():
    text = "one two three. four five\n\nsix seven eight nine ten"
    got = chunk.split_recursively(text, 20, 5)
    assert got == ["one two three", ". four five", "six seven eight", "nine ten"]
    assert chunk.split_recursively("x" * 50, 20, 5) == ["x" * 50]
    assert chunk.split_recursively("  ", 20, 5) == []


def entities(spark, rows):
    return spark.createDataFrame([(i, n, t, d, list(a), list(b)) for i, (n, t, d, a, b) in enumerate(rows)], "ord long, name string, type string, description string, inputs array<string>, outputs array<string>")


def test_sieves(spark):
    rows = [("a", "model", "x" * 20, (), ()), ("ab", "", "x" * 12, (), ()), ("b" * 60, "other", "", ("i",), ()), ("b" * 60, "Module", "x" * 11, (), ()), ("c" * 61, "module", "", ("i",), ()), ("Author", "module", "x" * 20, (), ()), (None, None, None, (), ("o",)), ("ok", "entity", "", (), ("o",))]
    e = entities(spark, rows)
    assert {r["ord"] for r in extract.relevant(e).collect()} == {1, 3}
    assert {r["ord"] for r in normalize.task_filter(e).collect()} == {0, 1, 4, 6}
    assert normalize.filter_or_all(e, F.lit(False)).count() == len(rows)
    assert normalize.filter_or_all(e, F.col("ord") == 2).count() == 1
    assert normalize.normalized(e).where("ord = 6").first()["id"] == "entity_6"
    twice = entities(spark, [("a", None, "", (), ()), ("a", None, "x", (), ()), ("a", "b", "", (), ())])
    assert sorted(r["ord"] for r in extract.first_of_each(twice).collect()) == [0, 2]


def greedy(keys, least):
    used, out = set(), {}
    for i, a in enumerate(keys):
        if i in used:
            continue
        used.add(i)
        out[i] = i
        for j in range(i + 1, len(keys)):
            s, t = set(a.split("_")), set(keys[j].split("_"))
            if j not in used and len(s & t) / len(s | t) >= least:
                used.add(j)
                out[j] = i
    return out


@pytest.mark.parametrize("least", [0.9, 0.5, 0.34])
def test_leaders_equal_greedy(spark, least):
    rng = random.Random(int(least * 100))
    keys = list(dict.fromkeys(["zm_model", "model_zm", "", *("_".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 5))) for _ in range(60))]))
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, bucket long")
    assert {r["bucket"]: r["leader"] for r in dedup.leaders(df, least).collect()} == greedy(keys, least)


def test_borderline_names_are_asked_about(spark):
    names = ["a b c d", "a b c e", "x", "a b c d e"]
    e = normalize.normalized(entities(spark, [(n, "t", "", (), ()) for n in names]))
    asked = []

    def ask(a, b):
        asked.append((a["id"], b["id"]))
        return b["id"] == "a_b_c_d_e"

    got = {r["bucket"]: r["leader"] for r in dedup.leaders_asking(e, ask, 0.9, 0.31).collect()}
    assert asked == [("a_b_c_d", "a_b_c_e"), ("a_b_c_d", "a_b_c_d_e")] and got == {0: 0, 1: 1, 2: 2, 3: 0}
    assert {r["leader"] for r in dedup.leaders_asking(e, ask, 0.9, 0.31, most=0).collect()} == {0, 1, 2, 3}


def test_merge(spark):
    e = entities(spark, [("B a", "x", "same", ("q", "p"), ("o",)), ("a B", "y", "same", ("p", "r"), ()), ("c", "z", None, (), ())])
    got = {r["ord"]: r for r in dedup.merged(dedup.clustered(normalize.normalized(e))).collect()}
    assert got[0]["type"] == "x" and got[0]["inputs"] == ["q", "p", "r"] and got[0]["alt_names"] == ["B a", "a B"] and got[0]["members"] == ["b_a", "a_b"]
    assert got[2]["inputs"] == [] and len(got) == 2


def test_links(spark):
    e = entities(spark, [("a", "", "", ("x y",), ("p q r", "p q r")), ("b", "", "", ("r q p", "q r"), ("x y z w",)), ("c", "", "", (), ())]).withColumn("id", F.lit("same"))
    got = sorted((r["label"], round(r["sim"], 4)) for r in relate.io_links(e).collect())
    assert got == [("p q r", 0.6667), ("p q r", 0.6667), ("p q r", 1.0), ("p q r", 1.0)]
    rng = random.Random(5)
    rows = [(f"n{i}", "", "", tuple(" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 5))) for _ in range(2)), tuple(" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 5))) for _ in range(2))) for i in range(40)]
    want = []
    for i, s in enumerate(rows):
        for o in s[4]:
            for j, d in enumerate(rows):
                for x in d[3]:
                    a, b = set(o.split()), set(x.split())
                    if i != j and a and len(a & b) / len(a | b) >= 0.62:
                        want.append((s[0], d[0], o))
    got = relate.io_links(entities(spark, rows).withColumn("id", F.col("name"))).collect()
    assert sorted((r["from"], r["to"], r["label"]) for r in got) == sorted(want)


def test_strongest_links_are_pruned_without_loss(spark):
    rng = random.Random(9)
    terms = ["hot term", "term hot", "a b c", "c b a", "b", "lone"]
    some = lambda most: tuple(rng.choice(terms[:5]) for _ in range(rng.randrange(most)))
    rows = [(rng.choice("uvwxyz"), "", "", some(4), some(4)) for _ in range(40)]
    rows += [("a", "", "", ("lone",) * 3, ("lone",) * 2), ("b", "", "", (), ("lone",)), (None, "", "", ("b",), ("b",))]
    e = entities(spark, rows).withColumn("id", F.col("name"))
    every = sorted((-r["sim"], r["from"], r["to"], r["label"]) for r in relate.io_links(e).collect())
    for most in (1, 5, 60, 5000):
        got = [(-r["sim"], r["from"], r["to"], r["label"]) for r in relate.strongest_io_links(e, most=most).collect()]
        assert got == every[:most]


def test_votes(spark):
    v = spark.createDataFrame([(0, "a", "b", "l"), (1, "a", "b", "l"), (2, "c", "d", None), (3, None, "d", "x")], "ord long, `from` string, `to` string, label string")
    p = v.where("ord = 3").drop("ord")
    assert [(r["from"], r["n"]) for r in relate.majority(v).collect()] == [("a", 2)]
    assert [tuple(r) for r in relate.voted_or(p, v.where("ord > 1")).collect()] == [(None, "d", "x")]
    assert sorted(map(str, (tuple(r) for r in relate.with_voted(p, v.where("ord > 1")).collect()))) == sorted(map(str, [(None, "d", "x"), ("c", "d", "")]))


def test_graph(spark):
    e = spark.createDataFrame([(0, "a", "z"), (1, "y", "z")], "ord long, `from` string, `to` string")
    n = spark.createDataFrame([("a",), (None,), ("",)], "id string")
    report = graph.validation_report(graph.dangling(e, n)).first()[0]
    assert report.split("\n")[3:] == ["Errors:", "- Edge to 'z' not in nodes", "- Edge from 'y' not in nodes", "- Edge to 'z' not in nodes", ""]
    assert graph.validation_report(graph.dangling(e.limit(0), n)).first()[0].endswith("\nNo issues detected.\n")
    x, none = spark.range(3), spark.range(0)
    assert tuple(graph.precision_recall(x, none, "id").first()) == (0.0, 0.0, 3, 0)
    assert tuple(graph.precision_recall(none, x, "id").first()) == (0.0, 0.0, 0, 3)
    assert tuple(graph.precision_recall(x, spark.range(2, 6), "id").first()) == (1 / 3, 0.25, 3, 4)


def test_render(spark):
    n = spark.createDataFrame([(0, "a", "a", 'A "x"', "f", ["i", "j"], [], "t"), (1, "b", "b", "b", "", None, ["o"], "t")], "ord long, id string, name string, romanian string, function string, inputs array<string>, outputs array<string>, type string")
    e = spark.createDataFrame([(0, "a", "b", 'l "q"'), (1, "b", "a", "")], "ord long, `from` string, `to` string, label string")
    assert render.puml(n, e).first()[0] == '@startuml\n[a] as "a (A "x")"\n[b]\n[a] -->> [b] : l "q"\n[b] -->> [a]\n@enduml'
    assert render.diagram(n, e, "dot").first()[0] == 'digraph G {\n  rankdir=LR;\n  node [shape=box];\n  "a" [label="a (A \\"x\\")"];\n  "b" [label="b"];\n  "a" -> "b" [label="l \\"q\\""];\n  "b" -> "a";\n}'
    assert render.markdown(n).first()[0] == '## a (A "x")\n**Responsibility**: f\n**Inputs**: i, j\n**Outputs**: —\n\n## b\n**Responsibility**: \n**Inputs**: —\n**Outputs**: o\n'


def test_answers(spark):
    prompts = spark.createDataFrame([("0", "p"), ("1", "q")], "unit string, prompt string")
    a = json.dumps({"entities": [{"name": "A", "inputs": ["x"]}, {"id": "B", "description": 5, "type": ""}]})
    got = model.responses(prompts, model.Replay({"p": [a, "no json", "x " + a]}), n=3)
    rows = extract.coerced(extract.from_answers(got.where("status = 'ok'"))).collect()
    assert sorted((r["sample_idx"], r["pos"], r["name"], r["type"], r["description"]) for r in rows) == [(0, 0, "A", "component", ""), (0, 1, "B", "component", ""), (2, 0, "A", "component", ""), (2, 1, "B", "component", "")]
    assert [r["unit"] for r in model.failed_units(got).collect()] == ["1"]


def test_retrieval(spark):
    v = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(6)], "id long, vector array<float>")
    assert [r["id"] for r in retrieve.nearest(v, [2.5, 0.0], 3).orderBy("rank").collect()] == [2, 3, 1]
    got = retrieve.nearest_of_each(v, [(7, [0.0, 0.0]), (8, [5.0, 0.0])], 2).collect()
    assert sorted((r["query"], r["rank"], r["id"]) for r in got) == [(7, 1, 0), (7, 2, 1), (8, 1, 5), (8, 2, 4)]
