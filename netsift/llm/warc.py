"""WARC archives and an external merge of their index (operator 5).

Writing: payload digests are computed beside the pages; of records with
equal payloads of ``LEAST_BYTES`` or more, the one with the largest page_id
is a response and the others revisit it (found by partial aggregation, so a
payload that a third of all pages have is no hot key). Spark writes one
gzipped WARC file per task through its committer, so a lost executor leaves
no half archive; a record is text in UTF-8 and its closing blank lines are
the line separator. ``X-Payload-Length`` keeps the full length of a payload
that a revisit leaves out.

Reading: each archive is parsed by Content-Length; digests of responses are
computed again from the payload read. Each archive is one capture run, sorted
by URL key, time and record. The run entries are dealt by ranges of the whole
sort key (a URL captured very often falls into several ranges) and in each
range the sorted runs are merged by a loser tree, which gives globally
ordered capture histories.

Edge cases: null html is an empty payload; a null url has an empty URL key
and no target header, control characters of a URL become %20; a null
page_id is an empty id and comes back null, always as a response; rows that
repeat a page_id are recorded each, a revisit by its own payload only, and
none refers to itself; an empty table
gives no rows. Pages have no capture time; the date follows from the page_id.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import checked, read, shared_path, staged, whole_text

LEAST_BYTES = 1000
FIRST_CAPTURE = 1_700_000_000
END = "\r\n\r\n"
CAPTURE = "page_id bigint, url_key string, captured string, archive string, offset bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
ORDER = ["url_key", "captured", "page_id", "archive", "offset"]


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of the payloads that another page records."""
    body = whole_text("html")
    seen = pages.where("page_id is not null").select("page_id", F.unhex(F.sha1(body)).alias("digest"), F.octet_length(body).alias("n"))
    seen = staged(seen.where(F.col("n") >= LEAST_BYTES).drop("n"), "payloads")
    kept = seen.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
    kept = staged(kept.where("refers_to <> least").drop("least"), "kept")
    return staged(seen.join(kept, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct(), "revisits")


def write_archives(pages: DataFrame, path: str) -> None:
    body, url = whole_text("html"), F.col("url").cast("string")
    revisit = F.col("refers_to").isNotNull()
    content = F.when(revisit, "").otherwise(body)
    safe = F.regexp_replace(url, r"[\x00-\x1F\x7F]", "%20")
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    date = F.date_format(F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    headers = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), number, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), safe),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.lower(F.hex("digest"))),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
        F.concat(F.lit("X-Payload-Length: "), F.octet_length(body).cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string")),
    )
    digested = pages.select("page_id", "url", "html", F.unhex(F.sha1(body)).alias("digest"))
    records = digested.join(checked(revisits(pages), 64), ["page_id", "digest"], "left")
    records.select(F.concat(headers, F.lit(END), content).alias("value")).write.option("lineSep", END).option(
        "compression", "gzip"
    ).text(path)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host from the top level down, then port, path and query, without fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = ",".join(reversed(re.sub(r"^www\d*\.", "", host).split(".")))
    port = f":{port}" if port not in (None, 80, 443) else ""
    return f"{host}{port}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def records(data: bytes):
    """(offset, headers, payload) of an archive; every record is cut by its Content-Length."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        end = head + 4 + int(headers["Content-Length"])
        yield at, headers, data[head + 4 : end]
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end")
        at = end + 4


def unzipped(content: bytes) -> bytes:
    """All gzip members of a file, one after another (an archive may have one per record)."""
    out = []
    while content:
        z = zlib.decompressobj(31)
        out.append(z.decompress(content))
        if not z.eof:
            raise ValueError("a gzip member does not end")
        content = z.unused_data.lstrip(b"\0")  # some writers pad with zeros
    return b"".join(out)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives (see ``CAPTURE``)."""

    def number(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").rstrip(">")
        return int(digits) if digits else None

    def rows(batches):
        for files in batches:
            for name, content in zip(files["path"], files["content"]):
                data = unzipped(bytes(content)) if name.endswith(".gz") else bytes(content)
                out = []
                for at, h, payload in records(data):
                    revisit = h["WARC-Type"] == "revisit"
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest()
                    size = int(h["X-Payload-Length"]) if revisit else len(payload)
                    key = url_key(h.get("WARC-Target-URI"))
                    out.append((number(h["WARC-Record-ID"]), key, h["WARC-Date"], name.rsplit("/", 1)[-1], at, size, digest, h["WARC-Type"], number(h.get("WARC-Refers-To"))))
                p = pd.DataFrame(out, columns=[c.split()[0] for c in CAPTURE.split(", ")])
                yield p.astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(rows, CAPTURE)


class LoserTree:
    """K-way merge of sorted runs: inner nodes keep the losers, each step replays one path."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.tree = [-1] * max(1, self.k)
        for r in range(self.k):
            self.replay(r)

    def key(self, run: int):
        return self.runs[run][self.at[run]] if self.at[run] < len(self.runs[run]) else None

    def beats(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes before run ``b``; -1 is an empty seat, which beats all while runs enter."""
        if a < 0 or b < 0:
            return a < 0
        x, y = self.key(a), self.key(b)
        return x is not None and (y is None or (x, a) < (y, b))

    def replay(self, run: int) -> None:
        winner, node = run, (run + self.k) // 2
        while node > 0:
            if self.beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while self.k and (x := self.key(run := self.tree[0])) is not None:
            self.at[run] += 1
            yield x
            self.replay(run)


def merged_index(captures: DataFrame) -> DataFrame:
    """The captures in global order of ``ORDER``: every partition follows the one before."""
    runs = staged(captures.sortWithinPartitions("archive", *ORDER[:3]), "runs")
    null_first = [F.col(c).asc_nulls_first() for c in ORDER]

    def merge(batches):
        import itertools

        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        keys = list(zip(rows["url_key"], rows["captured"], rows["page_id"].fillna(-(2**63)).astype("int64"), rows["archive"], rows["offset"], range(len(rows))))
        by_run = [list(g) for _, g in itertools.groupby(keys, key=lambda x: x[3])]
        order = [x[-1] for x in LoserTree(by_run)]
        for start in range(0, len(order), 10_000):
            part = rows.iloc[order[start : start + 10_000]]
            yield part.astype({"page_id": "Int64", "refers_to": "Int64"})

    dealt = runs.repartitionByRange(*null_first).sortWithinPartitions("archive", *null_first[:3], null_first[4])
    return dealt.mapInPandas(merge, CAPTURE)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "archives")
    write_archives(read(spark, sf_dir, "pages"), path)
    return merged_index(read_archives(spark, path))
