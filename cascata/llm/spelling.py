"""Spelling variants: words of a corpus one edit apart, by a trie of letter-group counts.

Words are the results of the runs of ``[A-Za-z\\u00C0-\\u00FF]`` of all texts, with A-Z lower-cased; if 97 divides
the crc32 ``h`` of ``<doc_id>:<run>`` the run's code point ``h % length`` is left out. Those of at least five
code points that occur at least three times count.

A word's vector has the number of its letters in each of some groups. One inserted, deleted or replaced
letter raises one number by at most one and lowers one by at most one. The vectors form a trie, one number a
level. A search goes down it with a budget of one surplus and one deficit; words in the leaves that it
reaches are compared letter by letter. The deficit is spent first, so each pair is found from one side only:
a shorter word from the longer, and of two words as long the one with fewer letters at the first level that
differs from the other.

The trie is spread over the cluster: nodes of more than ``MOST`` words are split by their next number, in
Spark, level by level, and the searches of all words are passed down to the children that their budget
allows. Every node that is left is searched depth first by one task, with at most ``PROBES`` words to look for at
a time. Words of one full vector that are more than ``MOST`` are dealt in chunks.

The near word with the greatest count (ties: the least in code-point order) is a word's form if it occurs
twice as often or more; roots follow forms by doubling. Null texts have no words, a null id counts as
empty text, rows with equal ids count each, texts are read whole, and extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import release, store

#: Letters that are counted together, a level of the trie each; all others are the last group.
GROUPS = ("e", "a", "i", "n", "r", "t", "s", "o", "l", "d", "u", "c", "m", "h", "pb", "gqj", "fvw", "kxyz")
LEVELS = len(GROUPS) + 1
MOST, PROBES = 16384, 65536
SALTS = 16
#: Below so many words a node is compared as a whole.
FEW = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(documents: DataFrame) -> DataFrame:
    """``word`` for every run of every text."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit("([a-z\\u00C0-\\u00FF]+)"), F.lit(1))
    words = documents.select("doc_id", F.explode(runs).alias("word"))
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "word")
    hashed = words.withColumn("h", F.crc32(F.encode(named, "UTF-8")))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return hashed.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("word")).alias("word"))


def counted(documents: DataFrame, letters: int = 5, times: int = 3) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    words = occurrences(documents).where(F.length("word") >= letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def letters_in(word: Column, level: int) -> Column:
    """How many letters of a word are in a level's group; the last level has all that no group names."""
    if level < len(GROUPS):
        return F.length(word) - F.length(F.translate(word, GROUPS[level], ""))
    return F.length(F.translate(word, "".join(GROUPS), ""))


def vectors_of(words: list[str]) -> np.ndarray:
    """The same numbers for a list of words, a row each."""
    group = np.full(0x100, LEVELS - 1)
    for level, letters in enumerate(GROUPS):
        group[[ord(x) for x in letters]] = level
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    counts = np.bincount(owner * LEVELS + group[codes], minlength=len(words) * LEVELS)
    return counts.reshape(len(words), LEVELS)


def one_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class Trie:
    """Vectors in order; a node is a range of them, its children are the runs of equal next numbers."""

    def __init__(self, words: list[str], level: int):
        vectors = vectors_of(words)
        self.order = np.lexsort(vectors.T[::-1])
        self.words, self.vectors, self.level = [words[k] for k in self.order], vectors[self.order], level

    def search(self, probes: np.ndarray, up: np.ndarray, down: np.ndarray):
        """Pairs (probe, word) whose vectors lie within the budgets, ``up`` and ``down`` of which are spent.

        The deficit is spent before the surplus, so of two words only one finds the other; words of equal
        vectors find each other.
        """
        found = []

        def leaves(lo, hi, level, at, up, down):
            if level == LEVELS:
                found.append((np.tile(at, hi - lo), np.repeat(np.arange(lo, hi), len(at))))
                return
            apart = self.vectors[lo:hi, None, level:] - probes[None, at, level:]
            more, less = apart > 0, apart < 0
            ups, downs = np.maximum(apart, 0).sum(axis=2) + up, -np.minimum(apart, 0).sum(axis=2) + down
            ordered = (ups == 0) | (down > 0) | (less.argmax(axis=2) < more.argmax(axis=2))
            word, probe = np.nonzero((ups <= downs) & (downs <= 1) & ordered)
            found.append((at[probe], lo + word))

        def visit(lo, hi, level, at, up, down):
            if hi - lo <= FEW or level == LEVELS:
                leaves(lo, hi, level, at, up, down)
                return
            column = self.vectors[lo:hi, level]
            starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            wanted = probes[at, level]
            for k, start in enumerate(starts.tolist()):
                end = starts[k + 1] if k + 1 < len(starts) else hi - lo
                apart = column[start] - wanted
                more, less = up + np.maximum(apart, 0), down - np.minimum(apart, 0)
                # A surplus may be spent only once a deficit has been.
                live = np.flatnonzero((less <= 1) & (more <= down))
                if len(live):
                    visit(lo + start, lo + int(end), level + 1, at[live], more[live], less[live])

        if len(self.words) and len(probes):
            visit(0, len(self.words), self.level, np.arange(len(probes)), up, down)
        return found


NEAR = "word string, n_near long, best_n long, best string"


def near_in_node(key, index: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
    """Of the pairs found in a node, for both words: how many are near, and the first of them by count."""
    count: dict[str, int] = {}
    best: dict[str, tuple[int, str]] = {}

    def note(word, other, n):
        count[word] = count.get(word, 0) + 1
        rank = (-n, other)
        if word not in best or rank < best[word]:
            best[word] = rank

    if len(index) and len(probes):
        trie = Trie(index["word"].tolist(), int(index["depth"].iloc[0]))
        held_n = index["n"].to_numpy()[trie.order].tolist()
        words, own_n = probes["word"].tolist(), probes["n"].tolist()
        vectors = vectors_of(words)
        for at, leaf in trie.search(vectors, probes["up"].to_numpy(), probes["down"].to_numpy()):
            for p, w in zip(at.tolist(), leaf.tolist()):
                a, b = words[p], trie.words[w]
                # Of two words with the same letters both have found the other.
                if one_apart(a, b) and (len(a) != len(b) or a < b or (vectors[p] != trie.vectors[w]).any()):
                    note(a, b, held_n[w])
                    note(b, a, own_n[p])
    rows = [(word, n, -best[word][0], best[word][1]) for word, n in count.items()]
    return pd.DataFrame(rows, columns=["word", "n_near", "best_n", "best"])


def split(words: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of at most ``most`` words, or of one vector: ``index`` and the ``probes`` that reach them.

    Both have ``node, depth, word, n``; probes have what they spent, ``up`` and ``down``.
    """
    total = words.count()
    # Levels that would split nearly every node are taken at once; splitting more than needed is harmless.
    depth = min(LEVELS, int(math.log(max(1, total / most), 4)))
    index = words.withColumns({"node": F.lit(""), "depth": F.lit(0)})
    probes = index.withColumns({"up": F.lit(0), "down": F.lit(0)})
    for level in range(depth):
        index, probes = below(index, probes, level)
    settled, reached = [], []
    while True:
        index = store(index, "nodes")
        sizes = index.groupBy("node").agg((F.count("*") > most).alias("split"))
        # Salts spread a node with many words over several tasks.
        salted = sizes.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
        deep = F.col("split") & F.lit(depth < LEVELS)
        named = lambda df: df.withColumn("_s", salt).join(salted, ["node", "_s"]).withColumn("split", deep).drop("_s")
        index, probes = store(named(index), "nodes"), store(named(probes), "probes")
        settled.append(index.where(~F.col("split")).drop("split"))
        reached.append(probes.where(~F.col("split")).drop("split"))
        index, probes = index.where("split").drop("split"), probes.where("split").drop("split")
        if index.isEmpty():
            return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, reached)
        index, probes = below(index, probes, depth)
        depth += 1


def below(index: DataFrame, probes: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Both one level deeper: words in their own child, probes in every child that their budget allows."""
    value = letters_in(F.col("word"), level)
    child = lambda v: F.concat("node", v.cast("string"), F.lit("."))
    index = index.withColumns({"node": child(value), "depth": F.lit(level + 1)})
    steps = [F.struct(F.lit(d).alias("d"), F.lit(u).alias("u"), F.lit(w).alias("w")) for d, u, w in ((0, 0, 0), (1, 1, 0), (-1, 0, 1))]
    probes = (
        probes.withColumn("s", F.explode(F.array(*steps)))
        .where("up + s.u <= down and down + s.w <= 1")
        .withColumns({
            "node": child(value + F.col("s.d")), "depth": F.lit(level + 1),
            "up": F.col("up") + F.col("s.u"), "down": F.col("down") + F.col("s.w"),
        }).drop("s")
    )
    return index, probes


def near_words(words: DataFrame, most: int = MOST, many: int = PROBES) -> DataFrame:
    """``word, n_near, best_n, best`` of every word that has a near one; ``words`` has ``word, n``."""
    index, probes = split(words, most)
    held = index.groupBy("node").agg(F.count("*").alias("held"))
    asked = probes.groupBy("node").agg(F.count("*").alias("asked"))
    # Chunks of a node's words and of those looked for there; every chunk meets every other.
    chunks = store(held.join(asked, "node").select(
        "node", F.ceil(F.col("held") / most).cast("int").alias("wide"), F.ceil(F.col("asked") / many).cast("int").alias("high")
    ), "chunks")
    own = F.xxhash64("word")
    index, probes = index.join(chunks, "node"), probes.join(chunks, "node")
    index = index.withColumns({
        "i": F.pmod(own, "wide").cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("high") - 1))
    })
    probes = probes.withColumns({
        "j": F.pmod(own, "high").cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("wide") - 1))
    })
    keys = ["node", "i", "j"]
    a = index.select(*keys, "word", "n", "depth").groupBy(*keys)
    b = probes.select(*keys, "word", "n", "up", "down").groupBy(*keys)
    found = a.cogroup(b).applyInPandas(near_in_node, NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f"))
    return grouped.select("word", "n_near", (-F.col("f.n")).alias("best_n"), F.col("f.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words with a form: forms are followed to the last, twice as far in every round."""
    here = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = here.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = store(here.join(ahead, "root", "left").select("word", "root", "next"), "roots")
        release(here)
        if step.where("next is not null").isEmpty():
            return step.select("word", "root")
        here = store(step.select("word", F.coalesce("next", "root").alias("root")), "roots")
        release(step)


def variants(documents: DataFrame, letters: int = 5, times: int = 3, share: int = 2, most: int = MOST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus."""
    words = store(counted(documents, letters, times), "words")
    near = store(words.join(near_words(words, most), "word", "left"), "near")
    better = F.col("best_n") >= share * F.col("n")
    named = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n"),
    )
    last = roots(named.where("form is not null"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
