"""URL filters over a sorted digest array.

A list entry is a host followed by the start of a path, such as
``example.com/en/``; it fits its host and all subdomains where the URL's path
starts with the entry's.  Entries are kept as a sorted array of 64-bit xxhash
digests with their full strings beside it.  An executor maps the array from a
file of its own, probes it with vectorised binary search for every (suffix of
the host, start of the path) of a URL, and confirms each hit on the stored
string, so that colliding digests never decide.

Of the rules that fit a URL the longest decides, of equally long ones that with
the longer host; where none fits, the URL is blocked if a block list entry
fits, else allowed.  Lengths are code points, and A-Z in hosts lower case; other
characters stand for themselves, in entries too.

Rows: one for each input row, repeated rows alike; an empty table has none.
Null URLs and those without ``://`` have neither host nor path, fit nothing and
are allowed; URLs of any length are read whole; an empty list fits nothing.
Only the id and URL columns are read; others can have any name.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K

# The default rules, verdict and entry.
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: File of the default block list, one entry a line; a parameter, as lists are data of their users.
BLOCK_LIST = str(Path(__file__).with_name("block_list.txt"))

#: Entries up to which a list is sent to every executor; a longer one is joined by a shuffle.
MAPPED_ENTRIES = 2_000_000

_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, and from there up to ``?``, ``#`` or the end."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    stop = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    rest = rest[:stop]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_UPPER), path


def probes(host: str, path: str, sizes: Iterable[int]) -> list[str]:
    """Every entry that could fit: each suffix of the host at a label, each start of the path of a size that the list has."""
    if not host:
        return []
    labels = [host]
    at = host.find(".")
    while at >= 0:
        labels.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return [x + path[:n] for x in labels if x for n in sizes if n <= len(path)]


def host_length(entry: str) -> int:
    """Characters of an entry before its path."""
    at = entry.find("/")
    return len(entry) if at < 0 else at


def read_list(path: str = BLOCK_LIST) -> list[str]:
    """Entries of a file that the driver has: one a line; empty lines and those that start with ``#`` are none."""
    with open(path, encoding="utf-8") as f:
        return sorted({e for line in f if (e := line.strip()) and not e.startswith("#")})


class DigestArray:
    """Entries as sorted 64-bit digests, offsets and one block of strings, in a form that can be mapped from a file."""

    def __init__(self, entries: Iterable[str]):
        raw = sorted({e.encode() for e in entries}, key=lambda e: (xxhash.xxh64_intdigest(e), e))
        self.keys = np.array([xxhash.xxh64_intdigest(e) for e in raw], np.uint64)
        self.ends = np.cumsum([0, *map(len, raw)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = sorted({len(e) - host_length(e) for e in map(bytes.decode, raw)})

    def __getstate__(self) -> dict:
        return {"keys": self.keys.tobytes(), "ends": self.ends.tobytes(), "blob": self.blob.tobytes(), "sizes": self.sizes}

    def __setstate__(self, state: dict) -> None:
        """Maps the arrays from an unnamed file of this process."""
        self.sizes = state["sizes"]
        with tempfile.TemporaryFile() as f:
            at = []
            for name in ("keys", "ends", "blob"):
                at.append((f.tell(), len(state[name])))
                f.write(state[name])
            f.flush()

            def mapped(i: int, kind: type) -> np.ndarray:
                n = at[i][1] // np.dtype(kind).itemsize
                return np.memmap(f, kind, "r", offset=at[i][0], shape=(n,)) if n else np.zeros(0, kind)

            self.keys, self.ends, self.blob = mapped(0, np.uint64), mapped(1, np.int64), mapped(2, np.uint8)

    def find(self, probe: list[str]) -> np.ndarray:
        """Which of the strings are entries."""
        raw = [p.encode() for p in probe]
        digest = np.fromiter((xxhash.xxh64_intdigest(p) for p in raw), np.uint64, len(raw))
        lo = np.searchsorted(self.keys, digest, "left")
        hi = np.searchsorted(self.keys, digest, "right")
        out = np.zeros(len(raw), bool)
        for i in np.flatnonzero(hi > lo).tolist():
            out[i] = any(self.blob[self.ends[j] : self.ends[j + 1]].tobytes() == raw[i] for j in range(lo[i], hi[i]))
        return out


def longest(probe: list[str], fits: np.ndarray) -> str | None:
    """The longest entry that fits; of equally long ones, that with the longer host."""
    found = [p for p, ok in zip(probe, fits, strict=True) if ok]
    return max(found, key=lambda e: (len(e), host_length(e)), default=None)


_SCHEMA = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("listed", pa.string())])
_DDL = "page_id long, host string, path string, rule string, verdict string, listed string"


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, blocked: Iterable[str] | DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) of every row; listed is the block list entry that fits.

    ``rules`` are few; ``blocked`` may be a DataFrame with a column ``entry``,
    which is joined by a shuffle when it has more than ``MAPPED_ENTRIES`` rows;
    without it the list of ``BLOCK_LIST`` counts.
    """
    blocked = read_list() if blocked is None else blocked
    rules = dict((entry, verdict) for verdict, entry in rules)
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    large = None
    if isinstance(blocked, DataFrame):
        entries = blocked.select("entry").where("entry is not null").distinct()
        if entries.count() > MAPPED_ENTRIES:
            large, blocked = entries, ()
        else:
            blocked = [r[0] for r in entries.toLocalIterator()]
    shared = pages.sparkSession.sparkContext.broadcast((DigestArray(rules), DigestArray(blocked)))

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        fixed, listed = shared.value
        split = [split_url(u) for u in batch.column(1).to_pylist()]
        picked = []
        for array in (fixed, listed):
            every = [probes(h, p, array.sizes) for h, p in split]
            ends = np.cumsum([0, *map(len, every)])
            hit = array.find([p for x in every for p in x])
            picked.append([longest(x, hit[a:b]) for x, a, b in zip(every, ends[:-1], ends[1:], strict=True)])
        yield {
            "page_id": batch.column(0),
            "host": [h for h, _ in split],
            "path": [p for _, p in split],
            "rule": picked[0],
            "verdict": [rules[r] if r else "block" if e else "allow" for r, e in zip(*picked, strict=True)],
            "listed": picked[1],
        }

    out = pages.mapInArrow(K.mapper(rows, _SCHEMA), _DDL)
    return out if large is None else _by_join(out, large)


def _by_join(judged: DataFrame, entries: DataFrame) -> DataFrame:
    """The block list's part by a shuffled join on whole strings, for lists of any length."""
    sizes = [r[0] for r in entries.select(F.length(F.regexp_extract("entry", "/.*$", 0))).distinct().collect()]
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probe = F.flatten(F.transform(F.filter(suffixes, lambda s: s != ""), lambda s: F.filter(F.array(*[F.when(F.length("path") >= n, F.concat(s, F.substring("path", 1, n))) for n in sizes]), lambda x: x.isNotNull())))
    sites = judged.where("host <> ''").select("host", "path").distinct()
    slash = F.instr("entry", "/")
    host = F.when(slash == 0, F.length("entry")).otherwise(slash - 1)
    found = sites.withColumn("entry", F.explode(F.array_distinct(probe))).join(entries, "entry").groupBy("host", "path").agg(F.max(F.struct(F.length("entry").alias("n"), host.alias("h"), "entry")).alias("m"))
    return (
        judged.drop("listed")
        .join(found.select("host", "path", F.col("m.entry").alias("listed")), ["host", "path"], "left")
        .withColumn("verdict", F.when(F.col("rule").isNull() & F.col("listed").isNotNull(), "block").otherwise(F.col("verdict")))
        .select("page_id", "host", "path", "rule", "verdict", "listed")
    )
