"""Books and instructions from files, by Spark's readers, so any store will do."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions import text as tx

#: Suffixes in the order of preference when one book comes in several forms.
PREFERENCE = ("txt", "pdf", "docx", "doc")


def _text(content: bytes, suffix: str) -> str:
    if suffix == "txt":
        return content.decode("utf-8", "ignore")  # undecodable bytes are dropped, not replaced
    if suffix in ("docx", "doc"):
        return _docx(content)
    if suffix == "pdf":
        return _pdf(content)
    raise ValueError(f"unsupported book format: .{suffix}")


def _docx(content: bytes) -> str:
    """Paragraph texts of the body, one to a line."""
    import io
    import zipfile
    from xml.etree import ElementTree

    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{w}body")
    shown = {f"{w}t": lambda e: e.text or "", f"{w}tab": lambda e: "\t", f"{w}br": lambda e: "\n"}
    return "\n".join("".join(shown[e.tag](e) for e in p.iter() if e.tag in shown) for p in body.findall(f"{w}p"))


def _pdf(content: bytes) -> str:
    """Page texts, one after the other; needs the optional library pdfplumber."""
    import io

    try:
        import pdfplumber
    except ImportError as e:
        raise ValueError("reading PDF needs the optional library pdfplumber") from e
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return "\n".join(page.extract_text() or "" for page in pdf.pages)


def read_books(spark: SparkSession, path: str, to_ascii: bool = True, space: bool = True) -> DataFrame:
    """(path, book, suffix, text, error) of every file under `path` (file, folder or glob): normalised text or what failed.

    A file that is blank, unreadable or of an unknown form has an error and a null text.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for p, content in zip(part["path"], part["content"]):
                name = p.rsplit("/", 1)[-1]
                book, _, suffix = name.rpartition(".")
                try:
                    rows.append((p, book or name, suffix.lower(), _text(bytes(content), suffix.lower()), None))
                except Exception as e:  # noqa: BLE001 - told in the row, so that other files go on
                    rows.append((p, book or name, suffix.lower(), None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "book", "suffix", "text", "error"])

    read = files.mapInPandas(run, "path string, book string, suffix string, text string, error string")
    text = tx.normalized(F.col("text"), to_ascii, space)
    read = read.withColumn("text", text)
    blank = F.col("text").isNotNull() & tx.is_blank(F.col("text"))
    return read.withColumn("error", F.when(blank, F.concat(F.lit("no text in "), F.col("path"))).otherwise(F.col("error"))).withColumn("text", F.when(~blank, F.col("text")))


def preferred(books: DataFrame) -> DataFrame:
    """Of each book the first readable form in the order of PREFERENCE, else its last error."""
    from pyspark.sql import Window

    order = F.array_position(F.array(*[F.lit(s) for s in PREFERENCE]), F.col("suffix"))
    place = F.when(order > 0, order).otherwise(len(PREFERENCE) + 1)
    bad = F.col("text").isNull()
    rank = F.row_number().over(Window.partitionBy("book").orderBy(bad, F.when(bad, -place).otherwise(place), "path"))
    return books.withColumn("__n", rank).where("__n = 1").drop("__n")


def read_book(spark: SparkSession, folder: str, name: str = "book", to_ascii: bool = True, space: bool = True) -> str:
    """The text of the one book in a folder; three kinds of failure are told apart."""
    from pyspark.errors import AnalysisException

    try:
        found = read_books(spark, f"{folder}/{name}.*", to_ascii, space).where(F.col("suffix").isin(*PREFERENCE))
        row = preferred(found).where(F.col("book") == name).first()
    except AnalysisException:
        row = None
    if row is None:
        raise ValueError(f"no {name}.txt, {name}.pdf or {name}.docx in {folder}")
    if row["text"] is None:
        raise ValueError(row["error"])
    return row["text"]


def read_text(spark: SparkSession, path: str, to_ascii: bool = True, space: bool = True) -> str:
    """One normalised text file; ValueError if it is missing or blank."""
    from pyspark.errors import AnalysisException

    try:
        row = read_books(spark, path, to_ascii, space).first()
    except AnalysisException as e:
        raise ValueError(f"missing required file: {path}") from e
    if row is None or row["text"] is None:
        raise ValueError(row["error"] if row else f"missing required file: {path}")
    return row["text"]


def read_prompt(spark: SparkSession, folder: str, name: str) -> str:
    """A prompt template as it stands."""
    return spark.read.text(f"{folder}/{name}", wholetext=True).first()[0]


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


GOLD = "entities array<struct<id:string>>, edges array<struct<`from`:string,`to`:string,label:string>>"


def read_gold(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """Gold entities (id) and edges (from, to, label), or None where there is no gold file."""
    from pyspark.errors import AnalysisException

    try:
        gold = read_json(spark, path, GOLD)
    except AnalysisException:
        return None
    return gold.select(F.inline("entities")), gold.select(F.inline("edges"))


def exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def read_small(spark: SparkSession, path: str) -> dict:
    """A small JSON object, such as the manifest of a run."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
