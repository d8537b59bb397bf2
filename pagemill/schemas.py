"""Table schemas and the checked options of an import."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

IMAGE_TYPE = T.StructType(
    [T.StructField("src", T.StringType()), T.StructField("alt", T.StringType())]
)

#: One row per captured fetch.  ``seq`` is the stored ingest order and is unique.
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("request_url", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("redirect_urls", T.ArrayType(T.StringType())),
        T.StructField("status", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.BinaryType()),
        T.StructField("error", T.StringType()),
        T.StructField("failure_type", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("images", T.ArrayType(IMAGE_TYPE)),
    ]
)

FRONTIER_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("discovered_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("failure_type", T.StringType()),
        T.StructField("http_status", T.LongType()),
        T.StructField("final_url", T.StringType()),
        T.StructField("content_type", T.StringType()),
    ]
)

# The words of each option, and what a format strips when nothing is said.
ALLOWED: dict[str, tuple[str, ...]] = {
    "content_format": ("md", "html", "text"),
    "strip": ("scripts", "css", "whitespace", "clean", "image-data-urls", "none"),
    "strip_order": ("before-links", "after-links"),
    "clean": ("before-links", "after-links", "none"),
    "index_columns": ("text",),
}
STRIPPED_BY_FORMAT = {
    "md": frozenset({"clean"}),
    "text": frozenset({"clean"}),
    "html": frozenset({"scripts", "image-data-urls"}),
}


def _words(option: str, given: str | Sequence[str] | None) -> tuple[str, ...]:
    """The words given for an option, each once, in order; an unknown one is an error."""
    listed = given.split(",") if isinstance(given, str) else (given or ())
    words = tuple(dict.fromkeys(word for word in (str(item).strip() for item in listed) if word))
    unknown = [word for word in words if word not in ALLOWED[option]]
    if unknown:
        raise ValueError(f"{option} must contain only {', '.join(ALLOWED[option])}, not {unknown[0]!r}")
    return words


def _one_word(option: str, given: str) -> str:
    if given not in ALLOWED[option]:
        raise ValueError(f"{option} must be one of {', '.join(ALLOWED[option])}, not {given!r}")
    return given


def strip_kinds(
    content_format: str = "md",
    strip: str | Sequence[str] | None = None,
    clean: str | None = None,
) -> frozenset[str]:
    """The strip steps to run: those named by ``strip``, else by ``clean``, else by the format."""
    if strip is None:
        if clean is None:
            return STRIPPED_BY_FORMAT[content_format]
        return frozenset({"clean"} if _one_word("clean", clean) != "none" else ())
    kinds = frozenset(_words("strip", strip))
    if "none" in kinds and len(kinds) > 1:
        raise ValueError("strip: 'none' cannot be combined with others")
    return kinds - {"none"}


def strip_order(order: str = "before-links", clean: str | None = None) -> str:
    """Whether images are read before or after stripping; a ``clean`` that says so wins."""
    says = {} if clean is None else {"clean": _one_word("clean", clean)}
    if says.get("clean", "none") != "none":
        return says["clean"]
    return _one_word("strip_order", order)


def index_columns(columns: Sequence[str] | None) -> tuple[str, ...]:
    """Columns to build a term index on; only ``text`` is supported."""
    return _words("index_columns", columns)


@dataclass(frozen=True)
class ImportOptions:
    """What to import and how; every value is checked on construction.

    ``extract`` maps the accepted responses to rows (a response without a row is
    skipped); ``response_filter`` is a SQL predicate or a Column and replaces the
    default textual-content filter.  ``batch_size`` and ``frontier_batch_size`` bound the rows of
    a file of the page table and of the URL states; ``max_batch_bytes`` bounds what a micro-batch
    reads (whole files), ``max_batch_delay`` is the time between two.  ``buckets`` counts for
    tables that the import creates; ``write_waits`` are the seconds before each new attempt at a
    write that storage refused.  ``drop_boilerplate`` leaves out of the text of HTML pages the
    blocks that many pages of their host repeat, by the counts of all imports into the table.
    """

    domain: str | None = None
    url_filter: str | Sequence[str] | None = None
    response_filter: str | Column | None = None
    extract: Callable[[DataFrame], DataFrame] | None = None
    schema: T.StructType | None = None
    primary_key: str = "url"
    content_format: str = "md"
    strip: str | Sequence[str] | None = None
    strip_order: str = "before-links"
    clean: str | None = None
    limit: int | None = None
    batch_size: int | None = None
    max_batch_bytes: int | None = None
    max_batch_delay: float | None = 60
    frontier_batch_size: int | None = None
    include_sitemap: bool = False
    retry_failed: bool = False
    index_columns: Sequence[str] | None = None
    optimize_every: int | None = 5000
    drop_boilerplate: bool = False
    buckets: int = 16
    write_waits: Sequence[float] = (1, 2, 4)
    replace_whole_row: bool = False

    def __post_init__(self) -> None:
        if self.buckets <= 0:
            raise ValueError("buckets must be greater than zero")
        for name in ("batch_size", "frontier_batch_size", "max_batch_bytes", "max_batch_delay", "optimize_every"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be greater than zero or None")
        if self.primary_key == "":
            raise ValueError("primary_key must be non-empty")
        if self.limit is not None and self.limit < 0:
            raise ValueError("limit must be greater than or equal to zero")
        if self.drop_boilerplate and (self.content_format != "text" or self.extract is not None):
            raise ValueError("drop_boilerplate needs content_format 'text' and no extract")
        _one_word("content_format", self.content_format)
        self.kinds, self.order, self.indexed  # noqa: B018 - raise on bad words

    @property
    def kinds(self) -> frozenset[str]:
        return strip_kinds(self.content_format, self.strip, self.clean)

    @property
    def order(self) -> str:
        return strip_order(self.strip_order, self.clean)

    @property
    def indexed(self) -> tuple[str, ...]:
        return index_columns(self.index_columns)
