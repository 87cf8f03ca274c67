"""URL filters by a sorted array of 64-bit digests.

A list of rules (host and path, allow or block) becomes three files side by
side: the sorted xxhash keys of all rules, the place of each rule's text, and
the texts themselves.  Workers map the files into memory, so processes of one
machine share one copy.  For every URL the keys of all rules that could fit
(its host and the domains above it, with the path cut at each length that
some rule has) are looked up together by binary search; each hit is compared
with the stored text, so equal digests of different texts do no harm.

The files go out with Spark's own file distribution, which also reaches
executors that start later.  A list is configuration, not corpus: its size is
bounded by ``MOST_BYTES``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest size of a list's texts.
MOST_BYTES = 4 << 30
ALLOW, BLOCK = "allow", "block"


def write_list(rules: Iterable[tuple[str, str, str]], folder: str) -> str:
    """Write (host, path, verdict) rules; gives the common stem of the files.

    Of equal rules one stays, and block goes before allow.
    """
    rules, verdicts = list(rules), {}
    for host, path, verdict in rules:
        text = (host + path).encode()
        verdicts[text] = BLOCK if BLOCK in (verdict, verdicts.get(text)) else ALLOW
    hosts = {(host + path).encode(): len(host.encode()) for host, path, _ in rules}
    if sum(map(len, verdicts)) > MOST_BYTES:
        raise ValueError(f"the list has more than {MOST_BYTES} bytes")
    order = sorted(verdicts, key=lambda t: (xxhash.xxh64_intdigest(t), t))
    stem = os.path.join(folder, f"urls-{uuid.uuid4().hex}")
    np.array([xxhash.xxh64_intdigest(t) for t in order], np.uint64).tofile(f"{stem}.keys")
    ends = np.cumsum([len(t) for t in order])
    meta = np.array([(e - len(t), e, hosts[t], verdicts[t] == BLOCK) for e, t in zip(ends, order, strict=True)], np.int64)
    meta.tofile(f"{stem}.meta")
    with open(f"{stem}.text", "wb") as file:
        file.write(b"".join(order))
    return stem


class DigestList:
    """The mapped files of one list."""

    def __init__(self, stem: str):
        mapped = lambda name, kind: np.memmap(f"{stem}.{name}", kind, "r") if os.path.getsize(f"{stem}.{name}") else np.zeros(0, kind)
        self.keys, self.text = mapped("keys", np.uint64), mapped("text", np.uint8)
        self.meta = mapped("meta", np.int64).reshape(-1, 4)
        self.path_lengths = np.unique(self.meta[:, 1] - self.meta[:, 0] - self.meta[:, 2])

    def look_up(self, texts: list[bytes]) -> np.ndarray:
        """Place of each text in the list, -1 where it is not there."""
        digests = np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))
        at = np.searchsorted(self.keys, digests, "left")
        out = np.full(len(texts), -1)
        for i in np.flatnonzero(np.append(self.keys, np.uint64(0))[at] == digests):
            k = at[i]
            while k < len(self.keys) and self.keys[k] == digests[i]:
                a, b = self.meta[k, :2]
                if self.text[a:b].tobytes() == texts[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def fits(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, bool]]:
        """The longest rule that fits each URL and whether it blocks; of equally long ones that with the longer host."""
        asked: list[bytes] = []
        owner: list[int] = []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            tail = path.encode()
            labels = host.split(".")
            # Empty hosts and cuts through a character have no rule.
            for d in range(len(labels) if host else 0):
                domain = ".".join(labels[d:]).encode()
                for length in self.path_lengths:
                    if length <= len(tail):
                        asked.append(domain + tail[:length])
                        owner.append(i)
        best: list[tuple[int, int, str | None, bool]] = [(-1, -1, None, False)] * len(hosts)
        if asked:
            found = self.look_up(asked)
            for j in np.flatnonzero(found >= 0):
                a, b, host_bytes, blocks = self.meta[found[j]]
                text = asked[j].decode()
                # The text alone could also be another host and path.
                if _domain_fits(hosts[owner[j]], text, int(host_bytes)):
                    best[owner[j]] = max(best[owner[j]], (len(text), int(host_bytes), text, bool(blocks)), key=lambda x: x[:2])
        return [(text, blocks) for _, _, text, blocks in best]


def _domain_fits(host: str, rule: str, host_bytes: int) -> bool:
    domain = rule.encode()[:host_bytes].decode()
    return host == domain or host.endswith("." + domain)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@cache
def _mapped(name: str) -> DigestList:
    return DigestList(SparkFiles.get(f"{name}.keys").removesuffix(".keys"))


def publish(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Write a list and hand it to all executors; gives its name for ``judge``.

    The driver's copy stays in Spark's own folder for such files, from which
    late executors are served as well.
    """
    context = spark.sparkContext
    stem = write_list(rules, SparkFiles.getRootDirectory())
    for part in ("keys", "meta", "text"):
        context.addFile(f"{stem}.{part}")
    return os.path.basename(stem)


def judge(pages: DataFrame, name: str, id: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each row.

    A rule fits its host and all subdomains, if the path of the URL starts
    with the rule's path.  Without a rule the verdict is ``default``.  Null
    URLs and those without ``://`` have an empty host and path and no rule.
    Only ``id`` and ``url`` are read, so other columns may have any name.
    """
    body = pages.select(F.col(id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _mapped(name)
        for batch in batches:
            fits = own.fits(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            rules = pa.array([text for text, _ in fits], pa.string())
            verdicts = pa.array([default if text is None else BLOCK if blocks else ALLOW for text, blocks in fits], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rules, verdicts], ["page_id", "host", "path", "rule", "verdict"])

    kind = dict(body.dtypes)["page_id"]
    return body.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
