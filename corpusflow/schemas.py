"""Declared schemas (never inferred: inference would miss optional keys such as error_message)."""

from pyspark.sql import types as T

S = T.StringType()

CONFIG_BOOK = T.StructType(
    [
        T.StructField("id", S),
        T.StructField("title_original", S),
        T.StructField("author_original", S),
        T.StructField("pdf_url", S),
        T.StructField("language", S),
        T.StructField("title_english_slug", S),
        T.StructField("author_english_slug", S),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("name", S),
        T.StructField("url", S),
        T.StructField("language", S),
        T.StructField("process_flag", T.VariantType()),  # any JSON value, read by its truth
        T.StructField("limit", T.IntegerType()),
        T.StructField("books", T.ArrayType(CONFIG_BOOK)),
    ]
)

CONFIG = T.StructType(
    [
        T.StructField("domain_handlers", T.MapType(S, S)),
        T.StructField("pages", T.ArrayType(PAGE)),
    ]
)

STATE_COLUMNS = [
    "page_slug",
    "id",
    "title_original",
    "author_original",
    "title_english_slug",
    "author_english_slug",
    "language",
    "pdf_url",
    "local_pdf_path",
    "local_md_path",
    "local_docx_path",
    "status",
    "pdf_sha256_hash",
    "download_status",
    "ocr_status",
    "docx_conversion_status",
    "error_message",
]
BOOK_STATE = T.StructType([T.StructField(c, S) for c in STATE_COLUMNS])

# the size's JSON type decides how it is read: a number is cut, a text must be an integer
FILE_ENTRY = T.StructType([T.StructField("name", S), T.StructField("size", T.VariantType())])
FILE_LISTING = T.StructType([T.StructField("files", T.ArrayType(FILE_ENTRY))])

BLOCK = T.StructType(
    [
        T.StructField("block_id", S),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("text", S),
    ]
)
PAGE_METADATA = T.StructType(
    [
        T.StructField("page_num", S),
        T.StructField("blocks", T.ArrayType(BLOCK)),
    ]
)

# Status domain (fixed values)
COMPLETED = "completed"
PENDING = "pending"
FAILED = "failed"
IN_PROGRESS = "in_progress"
STAGES = ["download_status", "ocr_status", "docx_conversion_status"]
STAGE_NAMES = ["download", "ocr", "docx"]
