"""The whole run over one book: chunks, entities, graph, diagram, report. Stages are functions on lazy DataFrames.

Every model call is optional; where it fails the deterministic branch of that stage runs. Caches and the resume gate are
keyed by the hash of the text and of the settings that change the result.
"""

from __future__ import annotations

import hashlib
import json
import logging
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import jsonx
from quillgraph.functions import text as tx
from quillgraph.operators import chunk, dedup, extract, graph, model, normalize, relate, render, retrieve
from quillgraph.plans.config import Settings
from quillgraph.plans.shared import cut
from quillgraph.sources import files, sinks

log = logging.getLogger(__name__)

# What retrieval asks for in every section.
QUESTIONS = ("list of model components and their roles", "data/control flows between components; inputs and outputs")
ENTITY = "id string, name string, romanian string, type string, description string, inputs array<string>, outputs array<string>"


@dataclass
class Run:
    """Tables and texts of a finished run."""

    chunks: DataFrame
    sections: DataFrame
    entities: DataFrame
    groups: DataFrame
    nodes: DataFrame
    edges: DataFrame
    diagram: str
    markdown: str
    report: str


def run_key(text: str, s: Settings) -> str:
    """Hash of the text and of the settings that decide what is extracted."""
    used = {k: v for k, v in asdict(s).items() if k.startswith(("chunk", "full_ingestion", "embeddings", "self_", "llm_model", "llm_temperature"))}
    return hashlib.sha256((text + json.dumps(used, sort_keys=True)).encode()).hexdigest()


def index_key(text: str, s: Settings) -> str:
    """Hash of the text and of the settings that decide its chunks and their vectors."""
    return hashlib.sha256(json.dumps([text, s.chunk_size, s.chunk_overlap, s.embeddings_model]).encode()).hexdigest()


def heuristic(texts: DataFrame) -> DataFrame:
    """(unit, sample_idx, pos, name, type, description, inputs, outputs) by pattern, for units whose call failed."""
    none = F.array().cast("array<string>")
    found = extract.by_pattern(texts, "unit")
    return found.select("unit", F.lit(0).alias("sample_idx"), F.col("sentence_idx").alias("pos"), "name", "type", "description", none.alias("inputs"), none.alias("outputs"))


def answered(answers: DataFrame, texts: DataFrame) -> DataFrame:
    """Coerced entities of all answers, and by pattern of the texts (unit, text) whose call failed; ord over all units."""
    read = extract.coerced(extract.from_answers(answers.where("status = 'ok'")))
    back = heuristic(texts.join(model.failed_units(answers), "unit", "left_semi"))
    rows = read.select(*back.columns).unionByName(back)
    one = Window.partitionBy(F.lit(0)).orderBy(F.col("unit").cast("int"), "sample_idx", "pos")
    return rows.withColumn("ord", F.row_number().over(one) - 1)


def replaced(current: DataFrame, answers: DataFrame) -> DataFrame:
    """The entities of a strict JSON answer, or the current ones if the call failed or the answer holds none."""
    v = jsonx.parsed(F.col("text"))
    got = answers.where("status = 'ok'").select(F.posexplode(F.try_variant_get(v, "$.entities", "array<variant>")).alias("ord", "e"))
    typed = [F.try_variant_get("e", f"$.{n}", t).alias(n) for n, t in (x.split(" ") for x in ENTITY.split(", "))]
    new = got.select("ord", *typed)
    new = cut(new)
    return current if new.isEmpty() else new


def vector_index(chunks: DataFrame, embed: retrieve.Embedder, s: Settings, path: str | None) -> DataFrame:
    """(id, vector) of the chunks: the finished table at `path` if the settings allow, else made now and kept there if they do."""
    spark = chunks.sparkSession
    if path and s.reuse_vector_index and files.exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    made = retrieve.embedded(chunks, embed).select(F.col("chunk_idx").alias("id"), "vector")
    if not (path and s.persist_vector_index):
        return made
    sinks.write_table(made, path)
    return spark.read.parquet(path)


def entities_by_section(spark: SparkSession, chunks: DataFrame, outline: DataFrame, s: Settings, llm: model.Completer | None, system: str | None, english: bool, embed: retrieve.Embedder, index: str | None = None) -> DataFrame:
    picks = chunk.representatives(outline).join(chunks, ["doc_id", "chunk_idx"])
    vectors = vector_index(chunks, embed, s, index)
    asked = [(i, np.asarray(v).tolist()) for i, v in enumerate(embed(QUESTIONS))]
    near = retrieve.nearest_of_each(vectors, asked, 4).join(chunks.select(F.col("chunk_idx").alias("id"), "text"), "id")
    rag = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("t")).select("query", F.array_join(F.col("t.text"), "\n\n").alias("text")).orderBy("query").collect()
    context = retrieve.context(picks, F.array(*[F.lit(r["text"]) for r in rag]).cast("array<string>"))
    titled = context.join(outline.select("doc_id", "section_ord", "title"), ["doc_id", "section_ord"])
    texts = cut(titled.select(F.col("section_ord").cast("string").alias("unit"), F.col("context").alias("text"), model.section_prompt(F.col("title"), F.col("context"), english).alias("prompt")))
    answers = cut(model.responses(texts, llm, system, s.llm_temperature, max(1, s.self_consistency_samples)))
    return extract.first_of_each(extract.relevant(answered(answers, texts)))


def entities_by_batch(spark: SparkSession, chunks: DataFrame, s: Settings, llm: model.Completer | None, system: str | None, english: bool, cache: str) -> DataFrame:
    """All chunks in batches; what was extracted is kept before the sieve, and sieved whenever it is read."""
    if s.reuse_full_ingestion_cache and files.exists(spark, cache):
        found = spark.read.parquet(cache)
    else:
        texts = chunk.batches(chunks, s.full_ingestion_batch_size).select(F.col("batch").cast("string").alias("unit"), "text")
        texts = cut(texts.withColumn("prompt", model.extraction_prompt(F.col("text"), english)))
        answers = cut(model.responses(texts, llm, system, s.llm_temperature, max(1, s.self_consistency_samples)))
        sinks.write_table(extract.first_of_each(answered(answers, texts), "unit"), cache)
        found = spark.read.parquet(cache)
    return extract.relevant(found)


def relations(entities: DataFrame, s: Settings, llm: model.Completer | None, system: str | None, instructions: str) -> DataFrame:
    """(ord, from, to, label): links by similarity, replaced by what a majority of sampled answers names, if any."""
    links = cut(relate.strongest_io_links(entities, s.io_link_similarity_threshold, s.max_candidate_edges))
    order =Window.partitionBy(F.lit(0)).orderBy(F.desc("sim"), "from", "to", "label")
    proposed = links.withColumn("ord", F.row_number().over(order) - 1)
    ents = model.as_json(entities, "entities", "id", "name", "type", "description", "inputs", "outputs").first()[0]
    rels = model.as_json(proposed, "relations", "from", "to", "label").first()[0]
    prompt = entities.sparkSession.range(1).select(F.lit("0").alias("unit"), model.relations_prompt(instructions, F.lit(ents), F.lit(rels)).alias("prompt"))
    answers = cut(model.responses(prompt, llm, system, s.llm_temperature, max(2, s.self_consistency_samples)))
    votes = votes_of(answers, "relations")
    passed = cut(relate.majority(votes, s.self_consistency_samples))
    if passed.isEmpty():
        return proposed.select("ord", "from", "to", "label")
    return passed.select(F.col("first").alias("ord"), "from", "to", "label")


def votes_of(answers: DataFrame, field: str) -> DataFrame:
    """(ord, from, to, label) of every edge in every answer, in order of samples."""
    v = jsonx.robust(F.col("text"))
    each = answers.where("status = 'ok'").select("sample_idx", F.posexplode(F.try_variant_get(v, f"$.{field}", "array<struct<`from`:string,`to`:string,label:string>>")).alias("pos", "e"))
    one = Window.partitionBy(F.lit(0)).orderBy("sample_idx", "pos")
    return each.select((F.row_number().over(one) - 1).alias("ord"), "e.from", "e.to", "e.label")


def extract_and_link(spark: SparkSession, text: str, instructions: str, s: Settings, llm: model.Completer | None = None, prompts: dict[str, str] | None = None, embed: retrieve.Embedder | None = None, cache: str | None = None, index: str | None = None) -> Run:
    """All stages in order, without files but for the cache of the batch mode and the vectors at `index`, if it is given."""
    if not text.strip():
        raise ValueError("the book is empty")
    prompts = prompts or {}
    english = spark.range(1).select(tx.language(F.lit(instructions))).first()[0] == "en"
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    chunks = cut(chunk.token_windows(docs, s.chunk_size, s.chunk_overlap))
    outline = cut(chunk.or_default_section(chunk.sections(chunks), chunks))
    if s.full_ingestion:
        found = entities_by_batch(spark, chunks, s, llm, prompts.get("extractor"), english, cache or f"{s.output_dir}/entities-{run_key(text, s)[:16]}.parquet")
    else:
        found = entities_by_section(spark, chunks, outline, s, llm, prompts.get("extractor"), english, embed or retrieve.hashed_words(), index)
    found = cut(found)
    asked = lambda prompt, name: model.responses(spark.range(1).select(F.lit("0").alias("unit"), prompt.alias("prompt")), llm, prompts.get(name), 0.1)
    normal = normalize.normalized(found).select("ord", "id", "name", "romanian", "type", "description", "inputs", "outputs")
    listed = lambda rows: F.lit(model.as_json(rows, "entities", "name", "type", "description", "inputs", "outputs").first()[0])
    translated = replaced(normal, asked(model.translation_prompt(listed(found), english), "translator"))
    normal = cut(normal if translated is normal else normalize.from_answer(translated))
    ask = model.merge_judge(llm or model.Failing()) if s.use_llm_deduper else None
    groups = cut(dedup.merged(dedup.clustered(normal, s.name_similarity_threshold, ask, s.llm_similarity_band, s.llm_deduper_max_checks)))
    kept = cut(normalize.filter_or_all(groups, normalize.fits_task(groups)))
    chosen = replaced(kept, asked(model.filter_prompt(instructions, listed(kept)), "task_filter"))
    chosen = cut(chosen.select("ord", "id", "name", "romanian", "type", "description", "inputs", "outputs"))
    rels = relations(chosen, s, llm, prompts.get("logical_distiller"), instructions)
    nodes, edges = cut(graph.nodes(chosen)), cut(graph.edges(rels))
    if edges.isEmpty():
        edges = inferred(nodes, s, llm, prompts.get("graph_builder"))
    diagram = render.diagram(nodes, edges, s.diagram_format).first()[0]
    report = graph.validation_report(graph.dangling(edges, nodes)).first()[0]
    return Run(chunks, outline, chosen, groups, nodes, edges, diagram, render.markdown(nodes).first()[0], report)


def inferred(nodes: DataFrame, s: Settings, llm: model.Completer | None, system: str | None) -> DataFrame:
    """(ord, from, to, label) where no relation was distilled: links by similarity, then voted edges; none if the call fails."""
    links = cut(relate.strongest_io_links(nodes, s.io_link_similarity_threshold, s.max_candidate_edges))
    body = model.as_json(nodes, "nodes", "id", "name", "romanian", "function", "inputs", "outputs", "type").first()[0]
    prompt = nodes.sparkSession.range(1).select(F.lit("0").alias("unit"), model.edges_prompt(F.lit(body)).alias("prompt"))
    answers = cut(model.responses(prompt, llm, system, s.llm_temperature, max(1, s.self_consistency_samples)))
    voted = relate.new_votes(links, votes_of(answers, "edges"), s.self_consistency_samples)
    one = Window.partitionBy(F.lit(0))  # max_candidate_edges links at most, and what one answer names
    before = F.row_number().over(one.orderBy(F.desc("sim"), "from", "to", "label")) - 1
    after = F.row_number().over(one.orderBy("turn")) - 1 + s.max_candidate_edges
    both = links.select(before.alias("ord"), "from", "to", "label").unionByName(voted.select(after.alias("ord"), "from", "to", "label"))
    return cut(both if not answers.where("status = 'failed'").limit(1).count() else both.limit(0))


OUTPUTS = ("knowledge_graph.json", "cognitive_architecture.md", "architecture.puml", "ingestion_meta.json")


def may_skip(spark: SparkSession, text_hash: str, s: Settings) -> bool:
    """Whether a finished run of this text is there and the settings allow to rest on it."""
    if not (s.resume_from_cache and s.resume_skip_pipeline_if_complete):
        return False
    if not all(files.exists(spark, f"{s.output_dir}/{n}") for n in OUTPUTS):
        return False
    meta = files.read_small(spark, f"{s.output_dir}/ingestion_meta.json")
    same = meta.get("book_hash") == text_hash or s.resume_allow_hash_mismatch
    return same and (meta.get("full_ingestion") is True or not s.resume_require_full_ingestion)


def main(spark: SparkSession, s: Settings, llm: model.Completer | None = None) -> Run | None:
    """From files to files; None if the resume gate lets an earlier run stand. Without `llm` the endpoint of the settings is asked."""
    llm = llm or model.ChatEndpoint(s.llm_base_url, s.llm_api_key, s.llm_model)
    text = files.read_book(spark, s.input_dir, to_ascii=s.transliterate_text, space=s.normalize_whitespace)
    text_hash = hashlib.sha256(text.encode("utf-8", "ignore")).hexdigest()
    if may_skip(spark, text_hash, s):
        log.info("an earlier run of this text is complete")
        return None
    instructions = files.read_text(spark, f"{s.input_dir}/instructions.txt", s.transliterate_text, s.normalize_whitespace)
    prompts = {n: files.read_prompt(spark, s.prompts_dir, f"{n}.txt") for n in ("extractor", "translator", "task_filter", "logical_distiller", "graph_builder") if files.exists(spark, f"{s.prompts_dir}/{n}.txt")}
    out = s.output_dir
    run = extract_and_link(spark, text, instructions, s, llm, prompts, index=f"{out}/vector_index/{index_key(text, s)[:16]}.parquet")
    rows = lambda df: [r.asDict(recursive=True) for r in df.orderBy("ord").drop("ord").collect()]
    sinks.write_text(spark, f"{out}/cognitive_architecture.md", run.markdown)
    sinks.write_text(spark, f"{out}/architecture.puml", run.diagram)
    sinks.write_json(spark, f"{out}/knowledge_graph.json", {"nodes": rows(run.nodes), "edges": rows(run.edges)})
    sinks.write_text(spark, f"{out}/validation_report.txt", run.report)
    sinks.write_json(spark, f"{out}/deduper_report.json", {"groups": rows(dedup.report(run.groups))})
    sinks.write_json(spark, f"{out}/ingestion_meta.json", {"book_hash": text_hash, "full_ingestion": s.full_ingestion, "timestamp": datetime.now(UTC).replace(tzinfo=None).isoformat() + "Z"})
    gold = files.read_gold(spark, f"{s.input_dir}/gold.json")
    if gold is not None:
        report = graph.evaluation(run.entities, run.edges, *gold).collect()
        sinks.write_json(spark, f"{out}/eval_report.json", {r["kind"]: {k: v for k, v in r.asDict().items() if k != "kind"} for r in report})
    if s.diagram_format.lower() == "dot":
        sinks.write_text(spark, f"{out}/architecture.dot", run.diagram)
        if s.graphviz_render:
            sinks.render([s.graphviz_engine, "-Tpng", f"{out}/architecture.dot", "-o", f"{out}/architecture.png"])
    elif s.plantuml_cli:
        sinks.render([s.plantuml_cli, f"{out}/architecture.puml"])
    return run
