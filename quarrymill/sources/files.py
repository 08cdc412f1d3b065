"""Documents from folders of PDF, DOCX and TXT files, and tables from the pipeline's JSON layouts."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

QA_FIELDS = "instruction string, response string, category string, difficulty string, source string"
CHAT = "messages array<struct<role: string, content: string>>"


def docx_text(data: bytes) -> str:
    """Paragraphs that are not blank, between empty lines."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    found = ("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in root.iter(f"{_W}p"))
    return "\n\n".join(p for p in found if p.strip())


def pdf_text(data: bytes) -> str:
    """Pages one after another, by `pypdf` where it is installed, else by `plain_pdf_text`."""
    try:
        from pypdf import PdfReader
    except ModuleNotFoundError:
        return plain_pdf_text(data)
    return "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(data)).pages)


_STREAM = re.compile(rb"<<((?:(?!<<|stream).|<<.*?>>)*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
#: Strings, hexadecimal strings, and the operators that show text or begin a line.
_SHOWN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|(?<![\w/])(?:T[dDm*]|Tj|TJ|ET)(?!\w)|['\"]", re.DOTALL)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def plain_pdf_text(data: bytes) -> str:
    """Text of simple PDFs: content streams, plain or deflated, with strings in a one-byte encoding, a line for each move.

    Files with encrypted streams, object streams of text or fonts with encodings of their own need `pypdf`; what has no
    text at all here is an error.
    """
    if not data.lstrip().startswith(b"%PDF"):
        raise ValueError("not a PDF")
    pages = []
    for head, body in _STREAM.findall(data):
        if b"/FlateDecode" in head:
            try:
                body = zlib.decompress(body)
            except zlib.error:
                continue
        if b"BT" in body and (page := _shown(body)):
            pages.append(page)
    if not pages:
        raise ValueError("no readable text")
    return "\n".join(pages)


def _shown(body: bytes) -> str:
    lines: list[bytes] = [b""]
    for found in _SHOWN.findall(body):
        if found[:1] == b"(":
            piece = re.sub(rb"\\([0-7]{1,3})", lambda m: bytes([int(m[1], 8) & 255]), found[1:-1])
            lines[-1] += re.sub(rb"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), piece, flags=re.DOTALL)
        elif found[:1] == b"<":
            digits = re.sub(rb"\s", b"", found[1:-1])
            lines[-1] += bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        elif found in (b"Td", b"TD", b"Tm", b"T*", b"'", b'"', b"ET") and lines[-1]:
            lines.append(b"")
    return "\n".join(x.decode("cp1252", "replace") for x in lines if x)


def extracted(path: str, data: bytes) -> tuple[str, str]:
    """Text and status: ok, unsupported, or error for what can't be read."""
    kind = path.lower().rpartition(".")[2]
    try:
        if kind == "txt":
            return bytes(data).decode("utf-8"), "ok"
        if kind == "docx":
            return docx_text(bytes(data)), "ok"
        if kind == "pdf":
            return pdf_text(bytes(data)), "ok"
    except Exception:  # one bad file is a row with its status, not the end of the job
        return "", "error"
    return "", "unsupported"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """filename, text, status of the folder's files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,docx,txt}").load(folder)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(re.split(r"[\\/]", p)[-1], *extracted(p, c)) for p, c in zip(frame["path"], frame["content"])]
            yield pd.DataFrame(rows, columns=["filename", "text", "status"])

    return files.select("path", "content").mapInPandas(run, "filename string, text string, status string")


def wrapped(spark: SparkSession, path: str, field: str, row: str) -> DataFrame:
    """The rows of one array of a JSON document, with their place as idx."""
    found = spark.read.schema(f"{field} array<struct<{row}>>").option("multiLine", True).json(path)
    return found.select(F.posexplode(field).alias("idx", "row")).select(F.col("idx").cast("bigint").alias("idx"), "row.*")


def any_layout(spark: SparkSession, path: str, row: str = QA_FIELDS, required: bool = False) -> DataFrame:
    """The rows of `dataset`, else of `qa_pairs`, else none, which is an error if they are required."""
    kind = f"array<struct<{row}>>"
    found = spark.read.schema(f"dataset {kind}, qa_pairs {kind}").option("multiLine", True).json(path)
    rows = F.coalesce("dataset", "qa_pairs")
    if required:
        rows = F.coalesce(rows, F.raise_error(F.lit(f"{path}: neither dataset nor qa_pairs")).cast(kind))
    return found.select(F.posexplode(rows).alias("idx", "row")).select(F.col("idx").cast("bigint").alias("idx"), "row.*")


def in_pieces(spark: SparkSession, path: str, *fields: str, row: str = QA_FIELDS) -> DataFrame:
    """The rows of the first of `fields` that a document in pieces (`sinks.write_document`) has, with their place as idx.

    Pieces are read as lines, by as many tasks as they have blocks; a line's place is its place in its block and the lines
    of the blocks before it, which are a row for each block.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each block
    blocks = lines.groupBy("file", "block").agg(F.min("row").alias("low"), F.count("*").alias("n"))
    base = blocks.select("file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("base"))
    placed = lines.join(F.broadcast(base), ["file", "block"]).select("value", (F.col("base") + F.col("row")).alias("at"))
    # lines of rows begin with a brace or a comma; others are a few for each section
    marks = placed.where("not startswith(value, '{') and not startswith(value, ',')").orderBy("at").collect()
    begins = {m.value: (m.at, marks[i + 1].at) for i, m in enumerate(marks) if m.value.endswith(": [")}
    low, high = next((begins[f'"{f}": ['] for f in fields if f'"{f}": [' in begins), (0, 0))
    text = F.when(F.col("value").startswith(","), F.substring("value", 2, 2**31 - 1)).otherwise(F.col("value"))
    found = placed.where((F.col("at") > low) & (F.col("at") < high))
    return found.select((F.col("at") - low - 1).alias("idx"), F.from_json(text, row).alias("row")).select("idx", "row.*")


def chat_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, messages and reason of every line that is not blank of a file of chats.

    reason: null; `not_json`; `wrong_shape` for JSON without a list of messages; `short` for fewer than two messages.
    Lines of a wrong shape have no messages, and no line is left out: the next rule, or the caller, drops by reason.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    messages = F.from_json("value", CHAT)["messages"]
    rows = lines.select(F.col("value").alias("line"), messages.alias("messages"), F.try_parse_json("value").isNull().alias("bad"))
    reason = F.when(F.col("bad"), "not_json").when(F.col("messages").isNull(), "wrong_shape").when(F.size("messages") < 2, "short")
    return rows.select("line", "messages", reason.alias("reason"))


def qa_from_chats(spark: SparkSession, path: str, augmentation: bool = False, strict: bool = False) -> DataFrame:
    """Questions and answers of a file of chats, with default fields.

    Lines that can't be read, of a wrong shape or too short are left out (`chat_lines` has them, to be counted); if
    strict, the first such line is an error.
    """
    m = F.col("messages")
    fixed = {"category": "general", "difficulty": "intermediate", "source": "original"}
    if augmentation:
        fixed["augmentation_type"] = "original"
    rows = chat_lines(spark, path)
    if strict:
        bad = F.raise_error(F.concat(F.lit(f"{path}: "), F.col("reason"), F.lit(": "), F.substring("line", 1, 100)))
        rows = rows.withColumn("messages", F.when(F.col("reason").isNull(), m).otherwise(bad.cast(CHAT.split(" ", 1)[1])))
    else:
        rows = rows.where("reason is null")
    return rows.select(m[0]["content"].alias("instruction"), m[1]["content"].alias("response"), *(F.lit(v).alias(k) for k, v in fixed.items()))


def exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(conf).globStatus(where)
    return found is not None and len(found) > 0


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first path, or pattern, that is there."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(", ".join(paths))


def recovered(spark: SparkSession, raw: str, *checkpoints: str) -> DataFrame:
    """The pairs of the raw file; where it is missing, those that checkpoints have."""
    if exists(spark, raw):
        return wrapped(spark, raw, "qa_pairs", QA_FIELDS)
    return any_layout(spark, first_existing(spark, *checkpoints))


#: By language, the files that may hold a set, the best first; the last ones hold what was not augmented.
AUGMENTED = "{name}_HQ_augmented_detailed.json", "{name}_augmented_detailed.json"


def best_dataset(spark: SparkSession, folder: str, name: str, plain: str, include_augmented: bool = True, lines: str | None = None) -> DataFrame | None:
    """The best set of a folder: augmented files (unless they are not wanted), else `plain`, else the chats of `lines`;
    None where there is none."""
    candidates = [x.format(name=name) for x in AUGMENTED] if include_augmented else []
    for candidate in [*candidates, plain]:
        if exists(spark, f"{folder}/{candidate}"):
            return any_layout(spark, f"{folder}/{candidate}")
    if lines and exists(spark, f"{folder}/{lines}"):
        return qa_from_chats(spark, f"{folder}/{lines}", augmentation=True)
    return None


def to_publish(spark: SparkSession, prepared: dict[str, str], otherwise) -> dict[str, DataFrame | None]:
    """By language, the prepared chats if the files of all languages are there, else what `otherwise(language)` finds."""
    if all(exists(spark, p) for p in prepared.values()):
        return {language: qa_from_chats(spark, p, strict=True) for language, p in prepared.items()}
    return {language: otherwise(language) for language in prepared}
