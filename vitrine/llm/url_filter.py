"""URL rules by a sorted digest array.

Every rule is one string, host and path (``example.net/en/``).  The 64-bit xxhash digests of all
rules stand sorted in one file, with the rule texts behind them; Spark ships the file to every
executor once, and each Python worker maps it into memory.  A url asks for the pairs of its host
suffixes and those path prefixes whose length some rule has; all digests of a batch are found by one
vectorised binary search, and a hit counts only if the stored text is the same.  The longest
rule wins (of two equally long ones, the one with the longer host).

The file holds 16 bytes and the text of each rule.  It is made in the driver only up to
``most`` rules; a longer list is matched by a join on the digest instead, with the same result.

A null url, or one without ``://``, has an empty host and path and no rule.  Repeated rows give
repeated results, rows without an id keep a null id, an empty table or an empty rule list gives a
defined result (no rule, the default verdict), and other columns play no part.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches

# Fixed values: (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: rules that the driver writes into one file, at most
MOST = 1_000_000

RESULT = "page_id long, host string, path string, rule string, verdict string"

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_WORKER: dict = {}


def host_and_path(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    stop = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[stop:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:stop].translate(_LOWER), path[:end]


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Host suffixes with path prefixes, the longest text first."""
    suffixes, rest = [host], host
    while "." in rest:
        rest = rest.partition(".")[2]
        suffixes.append(rest)
    found = [(len(s) + n, len(s), s + path[:n]) for s in suffixes for n in lengths if n <= len(path)]
    return [text for *_, text in sorted(found, reverse=True)]


def path_length(rule: str) -> int:
    return len(rule) - rule.find("/") if "/" in rule else 0


class DigestArray:
    """Sorted digests with their texts in one file: count, digests, text ends, verdicts, texts."""

    @staticmethod
    def write(path: str, rules: list[tuple[str, str]]) -> None:
        latest = {rule: verdict for verdict, rule in rules}  # the last of equal rules holds
        rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), v == "block") for r, v in latest.items())
        lengths = sorted({path_length(r) for r in latest})
        with open(path, "wb") as f:
            f.write(np.array([len(rows), len(lengths), *lengths], dtype="<i8").tobytes())
            f.write(np.array([d for d, *_ in rows], dtype="<u8").tobytes())
            f.write(np.cumsum([len(t) for _, t, _ in rows], dtype="<i8").tobytes())
            f.write(bytes(block for *_, block in rows))
            f.write(b"".join(t for _, t, _ in rows))

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, k = raw[:16].view("<i8").tolist()
        at = 16 + 8 * k
        self.lengths = raw[16:at].view("<i8").tolist()
        self.digests = raw[at : at + 8 * n].view("<u8")
        self.ends = raw[at + 8 * n : at + 16 * n].view("<i8")
        self.blocks = raw[at + 16 * n : at + 17 * n]
        self.texts = raw[at + 17 * n :]

    def text(self, i: int) -> bytes:
        return self.texts[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])].tobytes()

    def find(self, texts: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """Index of each text, or -1; texts with one digest stand side by side and are all compared."""
        keys = np.fromiter(map(digest, texts), dtype=np.uint64, count=len(texts))
        first = np.searchsorted(self.digests, keys, side="left")
        last = np.searchsorted(self.digests, keys, side="right")
        out = np.full(len(texts), -1, dtype=np.int64)
        for k in np.flatnonzero(last > first).tolist():
            for i in range(int(first[k]), int(last[k])):
                if self.text(i) == texts[k]:
                    out[k] = i
        return out


def ship(spark: SparkSession, rules: list[tuple[str, str]]) -> str:
    """Write the digest file and hand it to all executors, also to those that join later; gives its name there."""
    name = f"rules-{uuid.uuid4().hex}.bin"
    folder = tempfile.mkdtemp(prefix="rules-")
    DigestArray.write(os.path.join(folder, name), rules)
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]] | DataFrame = RULES, page_id: str = "page_id", url: str = "url",
    default: str = "allow", most: int = MOST,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    ``rules`` is a list of (verdict, rule) or a table with those two columns.
    """
    if isinstance(rules, DataFrame):
        head = rules.select("verdict", "rule").where("rule IS NOT NULL").limit(most + 1).collect()
        if len(head) > most:
            return _joined(pages, rules, page_id, url, default)
        rules = [(r.verdict, r.rule) for r in sorted(head, key=lambda r: (r.rule, r.verdict))]
    name = ship(pages.sparkSession, list(rules))

    def start():
        if _WORKER.get("name") != name:
            _WORKER.update(name=name, array=DigestArray(SparkFiles.get(name)))
        array = _WORKER["array"]

        def judge(rows: dict) -> dict:
            places = [host_and_path(u) for u in rows["url"]]
            asked, owner = [], []
            for k, (host, path) in enumerate(places):
                if host or path:
                    own = candidates(host, path, array.lengths)
                    asked += [t.encode("utf-8", "surrogatepass") for t in own]
                    owner += [k] * len(own)
            hits = array.find(asked)
            best: list = [None] * len(places)
            for j in np.flatnonzero(hits >= 0)[::-1].tolist():  # the first of a url is its longest
                best[owner[j]] = hits[j]
            return {
                "page_id": rows["page_id"], "host": [h for h, _ in places], "path": [p for _, p in places],
                "rule": [None if i is None else array.text(int(i)).decode() for i in best],
                "verdict": [default if i is None else "block" if array.blocks[i] else "allow" for i in best],
            }

        return judge

    return map_batches(_source(pages, page_id, url), RESULT, start)


def _source(pages: DataFrame, page_id: str, url: str) -> DataFrame:
    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"))


def _joined(pages: DataFrame, rules: DataFrame, page_id: str, url: str, default: str) -> DataFrame:
    """The same for a rule list of any size: distinct hosts and paths ask by a join on the rule's text."""
    lengths = [r[0] for r in rules.where("rule IS NOT NULL").selectExpr(
        "CASE WHEN instr(rule, '/') > 0 THEN length(rule) - instr(rule, '/') + 1 ELSE 0 END").distinct().collect()]

    def start():
        def split(rows: dict) -> dict:
            places = [host_and_path(u) for u in rows["url"]]
            return {
                "page_id": rows["page_id"], "host": [h for h, _ in places], "path": [p for _, p in places],
                "asked": [candidates(h, p, lengths) if h or p else [] for h, p in places],
            }

        return split

    rows = map_batches(_source(pages, page_id, url), "page_id long, host string, path string, asked array<string>", start)
    once = rules.where("rule IS NOT NULL").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    places = rows.groupBy("host", "path").agg(F.first("asked").alias("asked"))
    found = (
        places.select("host", "path", F.posexplode("asked").alias("at", "rule")).join(once, "rule")
        .groupBy("host", "path").agg(F.min_by(F.struct("rule", "verdict"), "at").alias("best"))
    )
    return rows.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
