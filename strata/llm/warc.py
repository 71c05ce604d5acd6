"""WARC archives (operator 3): written and read back as splittable files.

Writing. Of pages with equal payloads of at least ``min_bytes`` bytes the one
with the largest id is a ``response`` record, the others ``revisit`` records that
refer to it; smaller payloads are responses. Which payloads occur more than once
is one aggregate over digests; the pages are joined with those digests only
(broadcast by Spark while that list is small, else a join on the digest that
adaptive execution splits where one payload is very common). Spark's text writer
writes one archive a task, with its commit protocol, to any Hadoop file system.

Reading, by boundary-chain verification. An archive is read in splits, cut at the
record magic ``WARC/1.0``. The magic may also stand inside a payload, so each
piece is only a candidate: from its headers follows where its successor would
begin. In every split a task follows these links to the first offset beyond the
split (``_leave``). The few candidates at which some split is entered are then
resolved by pointer jumping from the file's start, doubling the distance each
round; a second look at each split keeps what its true entry reaches (``_walk``).
Pieces of a payload that look like records are never reached. A record that was
cut by a magic in its payload is put together again before it is digested.
Groups are splits of a file, bounded by ``spark.sql.files.maxPartitionBytes``.

Defined results: a null payload is empty; a null id can only be a response's if
all rows of that payload have none, and rows that share the largest id are all
responses; repeated rows give repeated records; control characters and spaces in
a URL are written as ``%20``, the line ends U+0085, U+2028 and U+2029 as their
bytes' escapes; a file is read up to its first broken record, and not at all if it
does not begin with one; extra columns are ignored; an empty table gives an empty
archive.

``write`` returns the number of records it wrote (observed by the write itself);
``read`` with ``expected`` raises ``LostRecords`` if it finds another number.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import col, materialized, table
from strata.session import scratch_path

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Times the archives are read if a cut record does not come back whole.
READS = 3
DATE = "2024-01-01T00:00:00Z"
_RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(data: Column) -> Column:
    """Base32 of the SHA-1: 160 bits as 12, 12 and 8 digits to the base 32."""
    h = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(h, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))
    ]
    return F.translate(F.concat(*parts), _DIGITS, _RFC4648)


class LostRecords(RuntimeError):
    """Fewer or more records were read than are known to be there."""


#: Line ends that are no control characters, as a URL writes them.
_LINE_ENDS = {"\u0085": "%C2%85", "\u2028": "%E2%80%A8", "\u2029": "%E2%80%A9"}


def _written_url(url: str) -> Column:
    out = F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")
    for sign, escape in _LINE_ENDS.items():
        out = F.replace(out, F.lit(sign), F.lit(escape))
    return out


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0
) -> DataFrame:
    """One column ``record``: the WARC record of each page, without its end."""
    rows = pages.select(
        col(page_id).alias("page_id"),
        F.coalesce(col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(col(payload).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"digest": F.unhex(F.sha1("payload")), "n": F.octet_length("payload")})
    several = materialized(
        rows.where(F.col("n") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1 and first_id is not null")
        .select("digest", "first_id"),
        "warc-several",
    )
    told = rows.join(several, "digest", "left").withColumn(
        "refers_to",
        F.when((F.col("n") >= min_bytes) & ~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id")),
    )
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        _urn(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        _written_url("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        sha1_base32(F.col("payload")),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                _urn(F.col("refers_to")),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
    )
    return told.withColumn("block", block).select(F.concat(head, F.col("block")).alias("record"))


def write(pages: DataFrame, path: str, **how) -> int:
    """Write ``pages`` as WARC files under ``path``, one a task; returns the number
    of records."""
    seen = Observation(f"warc_{uuid.uuid4().hex[:8]}")
    records(pages, **how).observe(seen, F.count(F.lit(1)).alias("n")).write.option("lineSep", END).text(path)
    return int(seen.get.get("n") or 0)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic: ``file, split, seq, value``. ``seq`` rises
    along a split (a scan of the same files deals the same numbers)."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
        )
    )


def _header(name: str, pattern: str = r"([^\r\n]*)") -> Column:
    # (?d): a line ends at a line feed, not at U+0085, U+2028 or U+2029
    return F.regexp_extract("head", rf"(?imd)^{name}:[ \t]*{pattern}[ \t]*\r?$", 1)


def _parsed(df: DataFrame) -> DataFrame:
    """Reads ``value`` (a record without its magic) and drops it."""
    df = df.withColumns(
        {
            "head": F.when(F.contains("value", F.lit(END)), F.substring_index("value", END, 1)),
            "bytes": F.col("value").cast("binary"),
        }
    ).withColumns(
        {
            "skip": F.octet_length("head") + 4,
            "length": F.nullif(_header("Content-Length", "([0-9]{1,15})"), F.lit("")).cast("long"),
            "held": F.octet_length("value").cast("long"),
        }
    )
    # of a whole record the payload is what follows the HTTP headers
    whole = F.col("skip") + F.col("length") + 4 == F.col("held")
    df = df.withColumn("whole", F.coalesce(whole, F.lit(False)))
    df = df.withColumn(
        "block", F.when(F.col("whole"), F.substring(F.col("bytes"), F.col("skip") + 1, F.col("length").cast("int")))
    )
    http = F.substring_index(F.col("block").cast("string"), END, 1)
    df = df.withColumn("http", http).withColumn(
        "payload", F.substring(F.col("block"), F.octet_length("http") + 5, F.octet_length("block"))
    )
    return df.withColumns(
        {
            "size": F.lit(len(MAGIC)) + F.col("skip") + F.col("length") + 4,
            "record_type": _header("WARC-Type"),
            "record_id": _header("WARC-Record-ID"),
            "target_uri": _header("WARC-Target-URI"),
            "refers_to": F.nullif(_header("WARC-Refers-To"), F.lit("")),
            "stated_digest": F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", ""),
            "stated_bytes": F.nullif(
                F.regexp_extract("http", r"(?imd)^Content-Length:[ \t]*([0-9]{1,15})", 1), F.lit("")
            ).cast("long"),
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": sha1_base32(F.col("payload")),
        }
    ).drop("value", "bytes", "block", "payload", "head", "http", "skip", "length")


def _leave(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, the first offset beyond the split that its
    chain leads to (-1: the chain breaks inside)."""
    pdf = pdf.sort_values("offset")
    at, after = pdf["offset"].to_numpy(), pdf["after"].to_numpy()
    place = np.searchsorted(at, after)
    out = after.copy()
    for i in range(len(at) - 1, -1, -1):
        j = place[i]
        if j < len(at):  # inside the split: the successor's answer, if there is one
            out[i] = out[j] if at[j] == after[i] else -1
    return pd.DataFrame({"file": key[0], "split": key[1], "offset": at, "leaves": out})


def _walk(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that its entry reaches."""
    pdf = pdf.sort_values("offset")
    at, after, entry = pdf["offset"].to_numpy(), pdf["after"].to_numpy(), pdf["entry"].to_numpy()
    place = np.searchsorted(at, after)
    reached = np.zeros(len(at), bool)
    for i in np.nonzero(entry)[0]:
        while i < len(at) and not reached[i]:
            reached[i] = True
            i = place[i] if place[i] < len(at) and at[place[i]] == after[i] else len(at)
    return pd.DataFrame({"file": key[0], "offset": at[reached]})


def _reached(candidates: DataFrame) -> DataFrame:
    """``file, offset`` of the candidates that the chain from the file's start
    reaches (``candidates``: ``file, split, offset, after``)."""
    slim = candidates.select("file", "split", "offset", "after")
    exits = materialized(
        slim.groupBy("file", "split").applyInPandas(_leave, "file string, split long, offset long, leaves long"),
        "warc-exits",
    )
    entered = exits.select("file", F.col("leaves").alias("offset")).distinct()
    jump = materialized(
        exits.join(entered, ["file", "offset"], "left_semi")
        .unionByName(exits.where("offset = 0"))
        .select("file", "offset", F.col("leaves").alias("to"))
        .distinct(),
        "warc-jump",
    )
    got = jump.where("offset = 0").select("file", "offset")
    known = got.count()
    while True:
        step = got.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        real = step.join(jump.select("file", "offset"), ["file", "offset"], "left_semi")
        got = materialized(got.union(real).distinct(), "warc-got")
        now = got.count()
        if now == known:
            break
        known = now
        further = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("beyond"))
        jump = materialized(
            jump.join(further, ["file", "to"], "left").select(
                "file", "offset", F.coalesce("beyond", F.lit(-1).cast("long")).alias("to")
            ),
            "warc-jump",
        )
    flagged = slim.join(got.withColumn("entry", F.lit(True)), ["file", "offset"], "left").select(
        "file", "split", "offset", "after", F.coalesce("entry", F.lit(False)).alias("entry")
    )
    return flagged.groupBy("file", "split").applyInPandas(_walk, "file string, offset long")


def read(spark: SparkSession, path: str, *, expected: int | None = None) -> DataFrame:
    """The verified records of the archives under ``path``: ``file, offset,
    record_type, record_id, target_uri, refers_to, stated_digest, stated_bytes,
    payload_bytes, payload_digest`` (the last two of the bytes read).

    Records that were cut are put together from a second scan, which Spark may
    split in another way if executors came or went in between. A record that then
    does not come back whole is noticed, and the archives are read again."""
    for _ in range(READS):
        found = _read(spark, path)
        if found is not None:
            break
    else:
        raise LostRecords(f"{path}: cut records did not come back whole")
    if expected is not None:
        found = materialized(found, "warc-records")
        if (n := found.count()) != expected:
            raise LostRecords(f"{path}: {n} records read, {expected} written")
    return found


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """See ``read``; ``None`` if the second scan was split in another way."""
    m = len(MAGIC)
    found = materialized(_parsed(_pieces(spark, path)), "warc-pieces")
    splits = found.groupBy("file", "split").agg(F.sum(F.col("held") + m).alias("n"))
    in_file = Window.partitionBy("file").orderBy("split")
    starts = splits.select(
        "file",
        "split",
        (F.sum("n").over(in_file) - F.col("n")).alias("start"),
        (F.sum("n").over(Window.partitionBy("file")) - m).alias("file_bytes"),
    )
    in_split = Window.partitionBy("file", "split").orderBy("seq")
    # a piece follows its magic; the first of a file has none
    placed = materialized(
        found.withColumn("before", F.sum(F.col("held") + m).over(in_split) - F.col("held") - m)
        .join(starts, ["file", "split"])
        .withColumn("offset", F.col("start") + F.col("before") - m)
        .withColumn("after", F.col("offset") + F.col("size"))
        .drop("start", "before"),
        "warc-placed",
    )
    candidates = placed.where("size is not null and offset >= 0 and after <= file_bytes")
    chain = materialized(_reached(candidates), "warc-chain")
    true = candidates.join(chain, ["file", "offset"])
    out = [
        "file", "offset", "record_type", "record_id", "target_uri", "refers_to", "stated_digest",
        "stated_bytes", "payload_bytes", "payload_digest",
    ]
    cut = materialized(true.where(~F.col("whole")).select("file", "offset", "after"), "warc-cut")
    whole = true.where("whole")
    if cut.isEmpty():
        return whole.select(*out)
    # pieces between a cut record's start and its successor belong to it
    marks = cut.select("file", "offset", F.col("offset").alias("owner"), F.col("after").alias("until"))
    pieces = placed.join(cut.select("file").distinct(), "file", "left_semi").select("file", "split", "seq", "offset")
    line = Window.partitionBy("file").orderBy("offset", F.asc_nulls_last("owner")).rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        pieces.unionByName(marks, allowMissingColumns=True)
        .withColumns({"owner": F.last("owner", ignorenulls=True).over(line), "until": F.last("until", ignorenulls=True).over(line)})
        .where("seq is not null and owner is not null and offset < until")
        .select("file", "split", "seq", "offset", "owner")
    )
    joined = (
        _pieces(spark, path)
        .join(owned, ["file", "split", "seq"])
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"))
        .select("file", F.col("owner").alias("offset"), F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).alias("value"))
    )
    again = materialized(_parsed(joined).where("whole"), "warc-again")
    if again.count() != cut.count():
        return None
    return whole.select(*out).union(again.select(*out))


def page_of(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """Query: every page as its WARC record says, after writing and reading."""
    path = scratch_path(spark, "warc")
    written = write(table(spark, sf_dir, "pages"), path)
    revisit = F.col("record_type") == "revisit"
    return read(spark, path, expected=written).select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


def _base32_sql(digest: str) -> str:
    """DuckDB SQL: base32 of a 40-digit hex text, 20 bits (four signs) at a time."""
    signs = []
    for at in range(1, 41, 5):
        bits = f"CAST('0x' || substr({digest}, {at}, 5) AS INTEGER)"
        signs += [f"substr('{_RFC4648}', (({bits} >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(signs)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
  q AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS first_id FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_base32_sql('digest')} AS payload_digest,
  CASE WHEN page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < first_id THEN first_id END AS refers_to
FROM q
"""
