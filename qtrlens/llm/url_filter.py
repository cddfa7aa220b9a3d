"""URL rules by a Bloom filter cascade.

A rule is a host and a path prefix, written ``host/path``; it fits its host
and all subdomains when the url's path starts with the rule's. The keys a url
could match are its host's suffixes (at label borders), each followed by a
prefix of its path of a length that some rule has. Over the complete universe
of such keys in the corpus a cascade is built: level 1 is a Bloom filter of
the listed keys, level 2 one of the unlisted keys that level 1 lets through,
level 3 one of the listed keys that level 2 lets through, and so on until no
level errs. For every key of the universe the first level that rejects it
tells, exactly, whether it is listed; no join is needed, the filters travel
with the tasks.

The filters' bits are bounded by the rule list: level 1 has
``BITS_PER_KEY * keys + log2(universe / keys)``-sized hashing so that about as
many unlisted keys pass as there are listed ones, and every later level holds
a fraction of that. Only those false positives reach the driver; if they
exceed ``max_passed`` per listed key level 1 is rebuilt with more bits.

Defined results: a null url or one without ``://`` has empty host and path,
matches no rule and is allowed. Null ids and repeated rows are judged like any
other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrlens.llm.common import stored

BITS_PER_KEY = 8
DEFAULT = "allow"


class Bloom:
    """Plain Bloom filter; ``salt`` makes the levels independent."""

    def __init__(self, keys, bits: int, hashes: int, salt: int):
        self.bits, self.hashes, self.salt = max(8, bits), max(1, hashes), salt
        self.data = bytearray((self.bits + 7) // 8)
        for k in keys:
            for p in self._places(k):
                self.data[p >> 3] |= 1 << (p & 7)

    def _places(self, key: str):
        d = hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16,
                            salt=self.salt.to_bytes(8, "little")).digest()
        a, b = int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little") | 1
        return [((a + i * b) & (2**64 - 1)) % self.bits for i in range(self.hashes)]

    def __contains__(self, key: str) -> bool:
        return all(self.data[p >> 3] >> (p & 7) & 1 for p in self._places(key))


class Cascade:
    """Levels of Bloom filters with exact answers on the universe."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1


def url_parts(url_col) -> tuple:
    """(host, path) columns of a url column."""
    url = F.coalesce(url_col, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))) \
        .otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    tail = F.substring(rest, F.length(host) + F.lit(1), F.length(rest))
    path = F.regexp_extract(tail, r"^([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def candidate_keys(host: str, path: str, lengths: list[int]):
    """Keys the url could match, the longest first (longer host first among
    keys of equal length)."""
    if not host or not path:
        return []
    hosts, at = [host], host.find(".")
    while at >= 0:
        hosts.append(host[at + 1:])
        at = host.find(".", at + 1)
    keys = [(len(h) + n, len(h), h + path[:n]) for h in hosts if h for n in lengths if n <= len(path)]
    return [k for _, _, k in sorted(keys, key=lambda x: (-x[0], -x[1]))]


def split_rule(rule: str) -> tuple[str, str]:
    at = rule.index("/")
    return rule[:at], rule[at:]


def key_universe(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """All different candidate keys of the corpus (``host``, ``path`` given)."""
    def run(batches):
        for b in batches:
            seen: dict[str, None] = {}
            for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen.update(dict.fromkeys(candidate_keys(h, p, lengths)))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["key"])
    short = urls.select("host", F.substring("path", 1, max(lengths)).alias("path")).distinct()
    return short.mapInArrow(run, "key string").distinct()


def _passing(level: Bloom):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k in b.column(0).to_pylist() if k in level], pa.string())], names=["key"])
    return run


def build_cascade(universe: DataFrame, listed: list[str], bits_per_key: int = BITS_PER_KEY,
                  max_passed: int = 64) -> Cascade:
    """Cascade for the listed keys over ``universe`` (column ``key``)."""
    listed = sorted(set(listed))
    if not listed:
        return Cascade([Bloom([], 8, 1, 1)])
    size = max(1, universe.count())
    bits = bits_per_key * len(listed) + max(0, math.ceil(len(listed) * math.log2(max(2, size / len(listed)))))
    member = set(listed)
    while True:                                   # level 1: probed by the whole universe
        first = Bloom(listed, bits, max(1, round(0.693 * bits / len(listed))), 1)
        allowed = max_passed * len(listed)
        wrong = [r.key for r in universe.mapInArrow(_passing(first), "key string")
                 .where(~F.col("key").isin(listed) if len(listed) <= 1000 else F.lit(True))
                 .limit(allowed + len(listed) + 1).collect() if r.key not in member]
        if len(wrong) <= allowed:
            break
        bits *= 2
    levels = [first]
    inside, other = sorted(wrong), listed         # next level encodes `inside`, errs on `other`
    while inside:
        n = len(inside)
        level = Bloom(inside, 2 * n + 8, 1, len(levels) + 1)
        levels.append(level)
        inside, other = [k for k in other if k in level], inside
    return Cascade(levels)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``; ``rules`` are
    (action, ``host/path``) pairs with actions ``allow`` or ``block``."""
    host, path = url_parts(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    lengths = sorted({len(split_rule(r)[1]) for _, r in rules})
    universe = stored(key_universe(urls, lengths), "op9-keys") if rules else None
    cascades = [(action, build_cascade(universe, [r for a, r in rules if a == action]))
                for action in ("allow", "block") if any(a == action for a, _ in rules)]

    def run(batches):
        for b in batches:
            rule, verdict = [], []
            for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                found = next(((k, a) for k in candidate_keys(h, p, lengths) for a, c in cascades if k in c),
                             (None, default))
                rule.append(found[0])
                verdict.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
