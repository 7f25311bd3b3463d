"""A whole run from files to files, settings, sources."""

import json
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from threading import Thread

import pytest

from quillgraph.operators import model
from quillgraph.plans import config, pipeline
from quillgraph.sources import files

BOOK = "Chapter 1\nThe Gate is a module that opens signal paths. The Lens is a system that focuses signal input. An Author is a agent that writes.\n"


def test_settings():
    s = config.load({"CHUNK_SIZE": "7", "Full_Ingestion": "yes"}, "chunk_size=9\n# x=1\nDIAGRAM_FORMAT='dot'\n")
    assert (s.chunk_size, s.full_ingestion, s.diagram_format, s.max_candidate_edges) == (7, True, "dot", 200)


@pytest.mark.parametrize("full", [False, True])
def test_run(spark, tmp_path, full):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/book.txt").write_bytes(BOOK.encode() + b"\xff")
    (tmp_path / "in/instructions.txt").write_text("Answer in English")
    (tmp_path / "in/gold.json").write_text(json.dumps({"entities": [{"id": "the_gate"}], "edges": []}))
    s = config.Settings(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), prompts_dir=str(tmp_path / "p"), full_ingestion=full, resume_from_cache=True, resume_skip_pipeline_if_complete=True, resume_require_full_ingestion=False)
    run = pipeline.main(spark, s)
    assert sorted(r["id"] for r in run.nodes.collect()) == ["the_gate", "the_lens"]
    assert "No issues detected." in (tmp_path / "out/validation_report.txt").read_text()
    assert json.loads((tmp_path / "out/knowledge_graph.json").read_text())["edges"] == []
    assert json.loads((tmp_path / "out/eval_report.json").read_text())["entities"]["recall"] == 1.0
    assert pipeline.main(spark, s) is None


def test_model_answers_are_used(spark):
    class Fixed:
        def query(self, user, system, temperature):
            return ""

        def query_n(self, user, system, temperature, n):
            if "Links found by comparing" in user:
                return [json.dumps({"relations": [{"from": "a", "to": "b", "label": "v"}]})] * 2 + ["?"]
            return ['{"entities": [{"name": "Aa", "description": "long enough text", "outputs": ["sig x"]}, {"name": "Bb", "inputs": ["sig x"]}]}'] * n

    run = pipeline.extract_and_link(spark, BOOK, "", config.Settings(), Fixed())
    assert sorted(r["id"] for r in run.nodes.collect()) == ["aa", "bb"]
    assert [(r["from"], r["to"], r["label"]) for r in run.edges.collect()] == [("a", "b", "v")]


def test_endpoint_of_the_settings_and_kept_vectors(spark, tmp_path):
    class Chat(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            told = '{"entities": [{"name": "Aa", "description": "long enough text", "outputs": ["sig x"]}, {"name": "Bb", "inputs": ["sig x"]}]}'
            body = json.dumps({"choices": [{"message": {"content": told if asked["n"] > 1 else ""}}] * asked["n"]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    (tmp_path / "in").mkdir()
    (tmp_path / "in/book.txt").write_text(BOOK)
    (tmp_path / "in/instructions.txt").write_text("Answer in English")
    server = ThreadingHTTPServer(("127.0.0.1", 0), Chat)
    Thread(target=server.serve_forever, daemon=True).start()
    s = config.Settings(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), prompts_dir=str(tmp_path / "p"), llm_base_url=f"http://127.0.0.1:{server.server_port}/v1")
    made = []
    for _ in range(2):
        run = pipeline.main(spark, s)
        assert sorted(r["id"] for r in run.nodes.collect()) == ["aa", "bb"]
        assert [(r["from"], r["to"], r["label"]) for r in run.edges.collect()] == [("aa", "bb", "sig x")]
        made.append([p.stat().st_mtime_ns for p in (tmp_path / "out/vector_index").glob("*/_SUCCESS")])
    server.shutdown()
    assert len(made[0]) == 1 and made[0] == made[1]


def test_inferred_edges_stand_by_similarity_then_votes(spark):
    class Edges(model.Failing):
        def query_n(self, user, system, temperature, n):
            return [json.dumps({"edges": [{"from": "z", "to": "a"}, {"from": "a", "to": "z"}, {"from": "b", "to": "c", "label": "p q"}]})] * n

    rows = [(0, "c", ["p q"], []), (1, "b", [], ["p q"]), (2, "a", [], ["p q r"])]
    nodes = spark.createDataFrame([(i, n, n, n, "", x, y, "t") for i, n, x, y in rows], "ord long, id string, name string, romanian string, function string, inputs array<string>, outputs array<string>, type string")
    got = pipeline.inferred(nodes, config.Settings(), Edges(), None).orderBy("ord").collect()
    assert [(r["from"], r["to"], r["label"]) for r in got] == [("b", "c", "p q"), ("a", "c", "p q r"), ("z", "a", ""), ("a", "z", "")]
    assert pipeline.inferred(nodes, config.Settings(), None, None).count() == 0


def test_book_as_it_stands(spark, tmp_path):
    (tmp_path / "book.txt").write_text("Ștefan   x", encoding="utf-8")
    assert files.read_book(spark, str(tmp_path)) == "Stefan x"
    assert files.read_book(spark, str(tmp_path), to_ascii=False, space=False) == "Ștefan   x"
    (tmp_path / "book.txt").write_text(" ")
    (tmp_path / "book.docx").write_text("no archive")
    with pytest.raises(ValueError, match="zip"):  # the last form's error, not the blank text's
        files.read_book(spark, str(tmp_path))


def test_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "book.docx", "w") as z:
        w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>Uno</w:t></w:r></w:p><w:p><w:r><w:t>dos</w:t></w:r></w:p></w:body></w:document>')
    assert files.read_book(spark, str(tmp_path)) == "Uno\ndos"
    (tmp_path / "book.txt").write_text(" \n")
    assert files.read_book(spark, str(tmp_path)) == "Uno\ndos"
    (tmp_path / "book.docx").unlink()
    with pytest.raises(ValueError, match="no text"):
        files.read_book(spark, str(tmp_path))
    (tmp_path / "book.txt").unlink()
    with pytest.raises(ValueError):
        files.read_book(spark, str(tmp_path))
    with pytest.raises(ValueError):
        files.read_text(spark, str(tmp_path / "none.txt"))


def test_failing_model_is_the_default():
    with pytest.raises(ConnectionError):
        model.Failing().query("x", None, 0.0)
