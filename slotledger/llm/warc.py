"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

Each record is made from its own response: nothing is shuffled, and a response becomes its two derivatives in one pass.
Everything is DataFrame expressions, except that texts with other character references than the usual ones are decoded
in Python, by the full HTML table.
"""

from __future__ import annotations

import html
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Parts of the record format.
VERSION = "WARC/1.1"
LINE = "\r\n"
RESPONSE_TYPE = "application/http; msgtype=response"
METADATA_TYPE = "application/warc-fields"
TEXT_TYPE = "text/plain; charset=UTF-8"
DATE = "1970-01-01T00:00:00Z"  # of captures whose time is not known

# Patterns that take a page to plain text, in order; they mean the same to every regular expression library.
# What is opened and not closed hides the rest of the page, and no tag holds another's bracket: so each pass is linear.
UNSEEN = (
    r"(?is)<!--(?:.*?-->|.*)|<title\b(?:.*?</title\s*>|.*)|<script\b(?:.*?</script\s*>|.*)|<style\b(?:.*?</style\s*>|.*)"
    r"|<template\b(?:.*?</template\s*>|.*)|<noscript\b(?:.*?</noscript\s*>|.*)"
)
# The same pattern with the bracket that all its parts begin with taken out: other characters then cost one look, not six.
HIDDEN = "(?is)<(?:" + UNSEEN.removeprefix("(?is)<").replace("|<", "|") + ")"
BREAKS = (
    r"(?i)</?(?:br|hr|p|div|h[1-6]|li|ul|ol|dl|dt|dd|table|tr|section|article|aside|nav|header|footer|main|form|pre"
    r"|blockquote|body|figure|figcaption)\b[^<>]*>"
)
TAGS = r"<[^<>]*>"
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)
# A reference that ENTITIES do not hold; texts without one need no Python.
OTHERS = "&(?!(?:" + "|".join(e[0][1:-1] for e in ENTITIES) + ");)[#A-Za-z]"
REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;?)")
SPACES = r"[ \t\r\f\x0B]+"
LINES = r" ?\n[ \n]*"
ENDS = r"\A[ \n]+|[ \n]+\z"  # for other engines; here these characters are trimmed


def urn(kind: str | Column, *parts: Column) -> Column:
    """A record id made from what the record is about, so that a second run gives the same."""
    digest = F.sha2(F.concat_ws("|", F.lit(kind), *parts), 256)
    cuts = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def sha256(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages as response records: page_id, record_id, target_uri, date, block (the HTTP message) and payload_digest.

    A null page has an empty payload, a null url an empty address.
    """
    html, url = F.coalesce(pages["html"], F.lit("")), F.coalesce(pages["url"], F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(LINE * 2),
    )
    return pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        urn("response", F.coalesce(pages["page_id"].cast("string"), F.lit("")), url).alias("record_id"),
        url.alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, html).alias("block"),
        sha256(html).alias("payload_digest"),
    )


@F.arrow_udf(StringType())
def _decoded(texts: pa.Array) -> pa.Array:
    """All character references, each once; a no-break space that a reference stands for is a space."""
    one = lambda m: html.unescape(m[0]).replace("\xa0", " ")
    return pa.array([None if t is None else REFERENCE.sub(one, t) for t in texts.to_pylist()], pa.string())


def untagged(page: Column) -> Column:
    text = F.regexp_replace(page, HIDDEN, " ")
    return F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")


def decoded(text: Column, other: Column) -> Column:
    """``other``: whether the text holds a reference that ENTITIES do not; a column of its own, as it is looked at twice."""
    usual = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)
    return F.when(other, _decoded(F.when(other, text))).otherwise(usual)


def plain_text(text: Column) -> Column:
    """From a decoded text without tags."""
    text = F.regexp_replace(F.regexp_replace(text, SPACES, " "), LINES, "\n")
    return F.btrim(text, F.lit(" \n"))


def record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """A whole record as text: named fields, an empty line, the block and two line ends."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in fields]
    return F.concat(F.lit(VERSION + LINE), *lines, F.lit(LINE), block, F.lit(LINE * 2))


def derivatives(source: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response record, both referring to it.

    Input as from ``responses``; block may be text or binary. The metadata block lists the HTTP status line and every
    source header as they stood; the conversion's block is the payload as plain text. Both keep the source's address,
    date and payload digest, and carry a digest of their own block. A block without an empty line is all headers and
    has an empty payload; null fields count as empty. One response gives two rows, repeated ones as well.
    Columns: page_id, type, record_id, refers_to, target_uri, content_type, content_length, block_digest,
    payload_digest (of the source), record (the whole record).
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("record_id", "target_uri", "date", "block", "payload_digest")]
    own = source.select("page_id", *filled)
    cut = F.locate(LINE * 2, F.col("block"))
    parted = own.select(
        "*",
        F.when(cut > 0, F.substring(F.col("block"), F.lit(1), cut - 1)).otherwise(F.col("block")).alias("head"),
        F.when(cut > 0, F.substring(F.col("block"), cut + 4, F.length("block"))).otherwise(F.lit("")).alias("payload"),
    )
    parted = parted.withColumn("payload", untagged(F.col("payload"))).withColumn("other", F.rlike("payload", F.lit(OTHERS)))
    parted = parted.withColumn("payload", decoded(F.col("payload"), F.col("other")))
    lines = F.split("head", LINE)
    headers = F.transform(F.filter(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x != ""), lambda x: F.concat(F.lit("http-header-"), x))
    named = F.concat(F.array(F.concat(F.lit("http-status-line: "), F.element_at(lines, 1))), headers)
    metadata = F.concat(F.array_join(named, LINE), F.lit(LINE))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("type"), F.lit(METADATA_TYPE).alias("content_type"), metadata.alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.lit(TEXT_TYPE).alias("content_type"), plain_text(F.col("payload")).alias("block")),
    )
    made = parted.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest", F.explode(kinds).alias("made")
    ).select("page_id", "refers_to", "target_uri", "date", "payload_digest", "made.*")
    finished = made.withColumns(
        {
            "record_id": urn(F.col("type"), F.col("refers_to")),
            "content_length": F.octet_length("block").cast("long"),
            "block_digest": sha256(F.col("block")),
        }
    )
    fields = [
        ("WARC-Type", F.col("type")),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("date")),
        ("WARC-Source-Payload-Digest", F.col("payload_digest")),
        ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")),
    ]
    return finished.select(
        "page_id", "type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "block_digest", "payload_digest",
        record(fields, F.col("block")).alias("record"),
    )
