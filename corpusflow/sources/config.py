"""The pipeline config as DataFrames.

The config is one small JSON document (``{"domain_handlers": {...}, "pages": [...]}``
or the legacy bare list of pages). It is parsed with a declared schema; pages and
inline books become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.urls import page_slug
from corpusflow.schemas import CONFIG, PAGE

# --- fixed values: per-page defaults -----------------------------------------
DEFAULT_PAGE_NAME = "Unknown Page"
DEFAULT_LANGUAGE = "kn-IN"
STRICT = {"mode": "FAILFAST"}
# JSON values that Python counts as false
FALSE_JSON = ["null", "false", '""', "[]", "{}"]
# ---------------------------------------------------------------------------


def parse_pages(text) -> Column:
    """array<page> from a config text in either layout (dict with ``pages`` or legacy list). A
    text that isn't such JSON fails the job: a truncated config must not pass for an empty one."""
    c = F.col(text) if isinstance(text, str) else text
    is_list = c.rlike(r"^\s*\[")
    return F.when(is_list, F.from_json(c, T.ArrayType(PAGE), STRICT)).otherwise(F.from_json(c, CONFIG, STRICT).getField("pages"))


def truthy(value: Column) -> Column:
    """Whether Python would take a JSON value (a variant; null: no such key) for true."""
    text = F.to_json(value)
    return F.coalesce(~text.isin(FALSE_JSON) & ~text.rlike("^-?0(?:[.]0*)?(?:[eE].*)?$"), F.lit(False))


def parse_handlers(text) -> Column:
    """array<struct<pattern, module>> in config order (empty for the legacy layout)."""
    c = F.col(text) if isinstance(text, str) else text
    m = F.from_json(c, CONFIG).getField("domain_handlers")
    entries = F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>"))
    return F.transform(entries, lambda e: F.struct(e["key"].alias("pattern"), e["value"].alias("module")))


def read_config(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per config document: ``config_path, pages, handlers``. A config file holds
    one document; with ``lines=True`` every line is a document (JSON Lines)."""
    raw = (spark.read.text(path) if lines else spark.read.text(path, wholetext=True)).withColumn(
        "config_path", F.input_file_name()
    )
    return raw.select("config_path", parse_pages("value").alias("pages"), parse_handlers("value").alias("handlers"))


def config_pages(cfg: DataFrame, pages_col: str = "pages", keep: list[str] | None = None) -> DataFrame:
    """One row per page with defaults applied and the page slug computed."""
    keep = keep or [c for c in cfg.columns if c not in (pages_col, "handlers")]
    exploded = cfg.select(*keep, F.posexplode(pages_col).alias("page_pos", "page"))
    p = F.col("page")
    return exploded.select(
        *keep,
        "page_pos",
        F.coalesce(p["name"], F.lit(DEFAULT_PAGE_NAME)).alias("page_name"),
        F.nullif(p["url"], F.lit("")).alias("page_url"),  # an empty url is no url
        F.coalesce(p["language"], F.lit(DEFAULT_LANGUAGE)).alias("page_language"),
        truthy(p["process_flag"]).alias("process_flag"),
        p["limit"].alias("page_limit"),
        p["books"].alias("books"),
    ).withColumn("page_slug", page_slug(F.col("page_url"), F.col("page_name")))


def enabled_pages(pages: DataFrame) -> DataFrame:
    """pages whose process_flag is truthy."""
    return pages.filter(F.col("process_flag"))


def inline_books(pages: DataFrame) -> DataFrame:
    """Inline books of the given pages, one row each, in config order."""
    base = [c for c in pages.columns if c != "books"]
    ex = pages.select(*base, F.posexplode("books").alias("book_pos", "book"))
    b = F.col("book")
    return ex.select(
        *base,
        "book_pos",
        b["id"].alias("id"),
        b["title_original"].alias("title_original"),
        F.coalesce(b["author_original"], F.lit("")).alias("author_original"),
        b["pdf_url"].alias("pdf_url"),
        b["language"].alias("book_language"),
        b["title_english_slug"].alias("title_slug_in"),
        b["author_english_slug"].alias("author_slug_in"),
    )
