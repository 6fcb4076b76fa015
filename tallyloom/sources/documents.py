"""Text corpora, manifests and table texts as DataFrames; PDF readers and model clients are handed in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import clean_text, strip
from tallyloom.operators.joins import keep_first

MIN_DIRECT = 50


def text_corpus(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """(source_path, source_file, text) of all .txt files below a root; a limit takes the first by path."""
    df = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    path = F.col("_metadata.file_path")
    df = df.select(path.alias("source_path"), F.element_at(F.split(path, "/"), -1).alias("source_file"), F.col("value").alias("text"))
    return df if limit is None else df.orderBy("source_path").limit(limit)


def pdf_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of all PDF files below a root, whatever the case of their suffix."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][dD][fF]").load(root).select("path", "content")


def read_pages(files: DataFrame, pages: Callable[[bytes], list[str]], ocr: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """(path, text, kind, method, status): direct text of 50 characters or more, else what ``ocr`` reads; a failure stays the file's own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    direct = "\n\n".join(x for x in pages(bytes(content)) if x.strip())
                except Exception:  # noqa: BLE001
                    direct = ""
                if len(direct.strip()) >= MIN_DIRECT:
                    rows.append((path, direct, "TEXT_BASED", "DIRECT_TEXT", "SUCCESS"))
                    continue
                try:
                    read = ocr(bytes(content)) if ocr else []
                    text = "\n".join(f"--- PAGE {i} ---\n{x}" for i, x in enumerate(read, 1))
                    rows.append((path, text, "IMAGE_BASED", "OCR", "SUCCESS" if any(x.strip() for x in read) else "OCR_NO_TEXT"))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, "", "IMAGE_BASED", "OCR", f"OCR_FAILED:{e}"))
            yield pd.DataFrame(rows, columns=["path", "text", "kind", "method", "status"])

    return files.mapInPandas(run, "path string, text string, kind string, method string, status string").withColumn("text", clean_text(F.col("text")))


def folder_below(path: Column, root: str) -> Column:
    """The first folder below the root, blank for files right in it."""
    parts = F.split(F.regexp_replace(path, f"^{root.rstrip('/')}/", ""), "/")
    return F.when(F.size(parts) >= 2, parts[0]).otherwise("")


def output_path(path: Column, source: str, target: str, suffix: str) -> Column:
    return F.regexp_replace(F.replace(path, F.lit(source), F.lit(target)), r"\.[^./]*$", suffix)


def split_table_text(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with quotation_number, boq_status and body: the two marks stand in the first five lines, which the body does not hold."""
    lines = F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n")
    head = F.slice(lines, 1, 5)
    value = lambda mark: F.coalesce(F.trim(F.regexp_replace(F.filter(head, lambda x: x.startswith(mark))[0], f"^{mark}", "")), F.lit(""))
    body = F.filter(head, lambda x: ~x.startswith("Quotation Number:") & ~x.startswith("BOQ Status:"))
    rest = F.slice(lines, F.lit(6), F.greatest(F.size(lines) - 5, F.lit(0)))
    return df.withColumns({"quotation_number": value("Quotation Number:"), "boq_status": value("BOQ Status:"), "body": strip(F.array_join(F.concat(body, rest), "\n"))})


def manifest(rows: DataFrame, pos: str) -> DataFrame:
    """The first row of each request and revision that has a path."""
    return keep_first(rows.where(F.coalesce(F.col("Revision_Path"), F.lit("")) != ""), ["RFQ", "Revision_Number"], pos)


def extract_with(client: Callable[[str], str], docs: DataFrame, key: str, text: str, retries: int = 5, pause: Callable[[int], None] | None = None) -> DataFrame:
    """(key, answer, error) from a model client, with retries inside of the task; ``pause`` is called with the number of the attempt."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for k, t in zip(part[key], part[text], strict=True):
                answer, error = None, None
                for attempt in range(retries):
                    try:
                        answer, error = client(t), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = str(e)
                        if pause:
                            pause(attempt)
                rows.append((k, answer, error))
            yield pd.DataFrame(rows, columns=[key, "answer", "error"])

    return docs.select(key, text).mapInPandas(run, f"{key} {docs.schema[key].dataType.simpleString()}, answer string, error string")


#: Texts that count as a price.
PRICE_TEXTS = ["quoted", "inclusive", "not used in a system"]


def valid_products(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``products`` (variant objects) and ``accepted``: products with a name, a numeric quantity and a number, null or known text as price.

    JSON may stand in a fenced block or among prose.  A document fails only if all its products do.
    """
    bare = F.regexp_extract(F.col(column), r"(?s)(\{.*\})", 1)
    parsed = F.try_parse_json(bare)
    products = F.try_variant_get(parsed, "$.products", "array<variant>")
    text = lambda p, k: F.try_variant_get(p, f"$.{k}", "string")
    number = lambda p, k: F.try_variant_get(p, f"$.{k}", "double")
    price = lambda p, k: text(p, k).isNull() | number(p, k).isNotNull() | F.lower(text(p, k)).isin(*PRICE_TEXTS)
    good = F.filter(products, lambda p: (F.coalesce(F.trim(text(p, "product_name")), F.lit("")) != "") & number(p, "quantity").isNotNull() & price(p, "unit_price") & price(p, "total_price"))
    return df.withColumn("products", good).withColumn("accepted", F.coalesce(F.size(products) == 0, F.lit(False)) | (F.coalesce(F.size("products"), F.lit(0)) > 0))
