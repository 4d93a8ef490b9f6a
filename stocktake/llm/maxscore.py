"""Exact top-k by inner product with MaxScore over sharded postings.

A vector is a bag of terms: the dimensions, weighted by integers. Candidates are
hashed into shards of about ``SHARD_ROWS`` rows and queries into blocks of about
``QUERY_ROWS``; every block meets every shard (a stated query set against all
rows). Within a pair the shard is indexed by term: a posting list of row and
weight, with its largest and smallest weight. For a query these give a bound per
term. A first threshold comes from the complete scores of the strongest rows of
the strongest terms; terms whose bounds together stay below it are
non-essential. The essential lists are traversed, and rows that can still
compete are probed in the other terms, strongest first. Shard results are merged
by rank. The threshold is always the score of k real rows, so no result is lost.

Defined results: vectors that are NULL or hold a NULL, NaN or infinite component
take no part, nor do rows without an id; a shorter vector lacks the later terms;
rows with the query's own id are no candidates; several query rows of one id
count once, by their smallest vector, while repeated candidate rows are candidates
each. Equal scores go to the smaller id. A vector with a component so large that
scores of its width need not fit 64 bits (beyond some 2**23 / sqrt(width)) takes no
part. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD_ROWS = 4096
QUERY_ROWS = 1024
#: Rows fully scored for the first threshold: so many heads of so many terms.
SEED_TERMS, SEED_HEADS = 6, 12


def quantized(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component; NULL for a vector that takes no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) >= 2.0 ** 40))
    return F.when(vec.isNotNull() & ~bad, F.transform(vec, lambda x: F.floor(x.cast("double") * scale)))


class Postings:
    """Term postings of one shard."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.by_term = ids[order], np.ascontiguousarray(rows[order].T)
        self.n = len(ids)
        self.lists = []
        for weights in self.by_term:
            at = np.flatnonzero(weights)
            self.lists.append((None, weights) if len(at) == self.n else (at, weights[at]))
        self.high = self.by_term.max(axis=1, initial=np.iinfo(np.int64).min)
        self.low = self.by_term.min(axis=1, initial=np.iinfo(np.int64).max)
        heads = min(SEED_HEADS, self.n)
        part = np.argpartition(self.by_term, (heads - 1, self.n - heads), axis=1) if self.n else np.zeros((len(rows.T), 0), int)
        self.bottom, self.top = part[:, :heads], part[:, self.n - heads:]

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``."""
        bound = np.maximum(query * self.high, query * self.low)
        by_bound = np.argsort(-bound, kind="stable")
        seeds = np.unique(np.concatenate([(self.top if query[t] > 0 else self.bottom)[t] for t in by_bound[:SEED_TERMS]]
                                         or [np.zeros(0, int)]))
        seeds = seeds[self.ids[seeds] != own]
        least = None
        if len(seeds) >= k:
            least = np.partition(query @ self.by_term[:, seeds], len(seeds) - k)[len(seeds) - k]
        # Essential: the terms before the point from which the others' bounds stay below the threshold.
        rest = np.concatenate([np.cumsum(bound[by_bound][::-1])[::-1], [0]])
        split = len(by_bound) if least is None else int(np.argmax(np.append(rest < least, True)))
        if split > len(by_bound):
            split = len(by_bound)
        score, seen = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
        for t in by_bound[:split]:
            at, weights = self.lists[t]
            if at is None:
                score += query[t] * weights
                seen[:] = True
            else:
                score[at] += query[t] * weights
                seen[at] = True
        if least is None or rest[split] >= least:
            seen[:] = True  # a row without any essential term could still compete
        live = np.flatnonzero(seen & (self.ids != own))
        score = score[live]
        for i in range(split, len(by_bound)):
            if least is not None:
                good = score + rest[i] >= least
                live, score = live[good], score[good]
            score = score + query[by_bound[i]] * self.by_term[by_bound[i], live]
        best = np.lexsort((self.ids[live], -score))[:k]
        return self.ids[live[best]], score[best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """One query block against one shard."""
    found = []
    if len(queries) and len(rows):
        width = max(queries["vec"].map(len).max(), rows["vec"].map(len).max())
        weights, wanted = _matrix(rows["vec"], width), _matrix(queries["vec"], width)
        if float(np.abs(weights).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * width >= 2.0 ** 62:
            raise ArithmeticError("components too large for 64-bit scores")
        index = Postings(rows["vec_id"].to_numpy(np.int64), weights)
        for own, q in zip(queries["vec_id"].to_numpy(np.int64), wanted):
            ids, scores = index.search(q, own, k)
            found.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row.

    ``is_query`` marks the stated query rows, by columns of ``vectors``.
    """
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), quantized(F.col(vec_col)).alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("q"))
            .where("vec IS NOT NULL AND vec_id IS NOT NULL"))
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    most = math.isqrt((1 << 62) // max(1, width)) - 1
    rows = rows.where(F.forall("vec", lambda x: F.abs(x) <= most))
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    # Each side is copied once per part of the other.
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asked = (rows.where("q").groupBy("vec_id").agg(F.min("vec").alias("vec"))
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
             .select("vec_id", "vec", "block", every(shards).alias("shard")))
    held = (rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)).cast("int"))
            .select("vec_id", "vec", "shard", every(blocks).alias("block")))
    part = (asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block"))
            .applyInPandas(lambda q, r: search_block(q, r, k), "query_id long, vec_id long, score long"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
