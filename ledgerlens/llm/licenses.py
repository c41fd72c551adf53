"""License scans by exact set-similarity join (operator 4, DataFrame functions only).

Finds every text block that holds at least ``threshold`` of a template's distinct words.
A block is a window of words; windows of 2n words every n words hold any run of n words
whole. Templates fall into length classes (short notices, whole licence texts), and n is at
least the longest template of the class.

The join never compares blocks with templates one by one:

* Global order: template words by the number of documents that hold them (counted over
  the whole corpus), rarest first. Other words cannot match and are left out.
* Prefix filter: an overlap of a = ceil(threshold x |T|) forces the first |T|-a+1 words of
  the template and the first |B|-a+1 words of the block to share one; an equality join on
  those few rare words gives the candidates.
* Length filter: |B| >= a. Positional filter: 1 + the shorter rest after the shared word >= a.
* Every candidate is verified by the true overlap, and by order: ``ORDERED`` of the template's pairs of
  neighbouring words must be neighbours in the block, and the phrase that tells a template from
  its likes (``TELLING``) must stand there whole. Sets alone can't tell notices apart that differ
  in one word, nor a licence from a text that happens to use its words.

Only documents that hold a prefix word of some template are cut into blocks. Template
tables are a fixed list, so they may be broadcast.

Besides, the base places: positions where the words of a phrase stand consecutively.

Defined results: NULL or word-less text has 0 words, no labels, score 0 and NULL
first_word/last_word; rows with the same doc_id and text get the same result, one row each;
NULL doc_id is an id like any other; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import NOT_WORD, ascii_lower, split_words, text_or_empty

# Phrases of the base labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices of well-known public licenses, by label.
TEMPLATES = {
    "apache-2-notice": "licensed under the apache license version 2 0",
    "mit-notice": "released under the mit license",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "gpl-3-notice": "this work is licensed under the gnu general public license version 3",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-2-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
}
STEP = 24

# The phrase by which each notice is told from others of nearly the same words.
TELLING = {
    "apache-2-notice": "apache license",
    "mit-notice": "mit license",
    "cc-by-nc-notice": "cc by nc",
    "gpl-3-notice": "gnu general public license",
    "bsd-notice": "source and binary forms",
    "mpl-2-notice": "mozilla public license",
    "mit-permission": "free of charge",
}

# The operative texts of well-known short licenses, by label.
BODIES = {
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to
        use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the
        software is furnished to do so subject to the following conditions the above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the software the software is provided as is without warranty
        of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other
        liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or
        the use or other dealings in the software""",
    "bsd-2-text": """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this
        list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution this software is provided by the copyright holders and contributors as is and any express or implied
        warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose
        are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental
        special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss
        of use data or profits or business interruption however caused and on any theory of liability whether in contract strict
        liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised
        of the possibility of such damage""",
    "isc-text": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies the software is provided as is
        and the author disclaims all warranties with regard to this software including all implied warranties of merchantability
        and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any
        damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other
        tortious action arising out of or in connection with the use or performance of this software""",
}
ORDERED = 0.6


def places(words: Column, phrase: list[str]) -> Column:
    """Ascending start positions (from 0) of a phrase in a word array."""
    n = F.size(words) - len(phrase)
    here = lambda i: reduce(Column.__and__, [F.get(words, i + k) == F.lit(p) for k, p in enumerate(phrase)])
    holds = reduce(Column.__and__, [F.array_contains(words, p) for p in phrase])
    return F.when((n >= 0) & holds, F.filter(F.sequence(F.lit(0), n), here)).otherwise(F.array().cast("array<int>"))


def worded(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).select(
        "doc_id", F.xxhash64("t").alias("h"), split_words(ascii_lower(F.col("t")), NOT_WORD).alias("words"))


def word_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """Template words, rarest in the corpus first (ties by the word); one row per template word."""
    known = F.array(*map(F.lit, vocabulary))
    counts = {r.w: r.n for r in words.select(F.explode(F.array_intersect("words", known)).alias("w"))
              .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def neighbours(words: Column) -> Column:
    """The distinct pairs of neighbouring words, as texts."""
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def in_order(block: Column, pairs: Column, telling: Column) -> Column:
    """Whether the block's words have enough of the template's neighbours and hold its telling phrase whole."""
    enough = F.size(F.array_intersect(neighbours(block), pairs)) >= F.lit(ORDERED) * F.size(pairs)
    return enough & F.contains(F.concat(F.lit(" "), F.array_join(block, " "), F.lit(" ")), F.concat(F.lit(" "), telling, F.lit(" ")))


def similar_blocks(words: DataFrame, templates: dict[str, str], threshold: float, step: int = STEP, telling: dict[str, str] | None = None) -> DataFrame:
    """doc_id, h, block (first word of the window), label, containment of every match.
    ``words``: doc_id, h, words (array of text); ``telling``: phrases that must stand in the block."""
    spark = words.sparkSession
    telling = telling or {}
    sets = {name: sorted(set(text.split())) for name, text in templates.items()}
    if max(len(t.split()) for t in templates.values()) > step:
        raise ValueError("step must be at least the longest template")
    order = word_order(words, sorted(set().union(*sets.values())))
    rank = {w: k for k, w in enumerate(order)}
    index, whole = [], []
    for name, own in sets.items():
        ranks, need = sorted(rank[w] for w in own), math.ceil(threshold * len(own) - 1e-9)
        text = templates[name].split()
        pairs = sorted({f"{a} {b}" for a, b in zip(text, text[1:], strict=False)})
        whole.append((name, ranks, need, pairs, telling.get(name, text[0])))
        index += [(r, i, name, len(own), need) for i, r in enumerate(ranks[:len(own) - need + 1])]
    least = min(x[2] for x in whole)
    prefix_words = [order[r] for r in sorted({x[0] for x in index})]
    prefixes = F.broadcast(spark.createDataFrame(index, "word int, i int, label string, t_size int, need int"))
    full = F.broadcast(spark.createDataFrame(whole, "label string, t_words array<int>, need int, pairs array<string>, telling string"))

    known, by_rank = F.array(*map(F.lit, order)), F.array(*map(F.lit, order))
    window = lambda at: F.array_intersect(F.slice("words", at + 1, 2 * step), known)
    blocks = (words.where(F.arrays_overlap("words", F.array(*map(F.lit, prefix_words))))
              .select("doc_id", "h", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1, F.lit(step))).alias("block"))
              .select("doc_id", "h", "block", window(F.col("block")).alias("own"), F.slice("words", F.col("block") + 1, 2 * step).alias("text"))
              .where(F.size("own") >= least)
              .select("doc_id", "h", "block", "text", F.array_sort(F.transform("own", lambda w: (F.array_position(by_rank, w) - 1).cast("int"))).alias("own")))
    candidates = (blocks.select("doc_id", "h", "block", "text", "own", F.size("own").alias("b_size"), F.posexplode(F.slice("own", 1, F.size("own") - least + 1)).alias("j", "word"))
                  .join(prefixes, "word")
                  .where((F.col("b_size") >= F.col("need")) & (F.col("j") <= F.col("b_size") - F.col("need"))
                         & (1 + F.least(F.col("t_size") - 1 - F.col("i"), F.col("b_size") - 1 - F.col("j")) >= F.col("need")))
                  .select("doc_id", "h", "block", "text", "own", "label"))  # a block can come by several words; the caller's labels are distinct
    shared = F.size(F.array_intersect("own", "t_words"))
    return (candidates.join(full, "label").where((shared >= F.col("need")) & in_order(F.col("text"), F.col("pairs"), F.col("telling")))
            .select("doc_id", "h", "block", "label", (shared / F.size("t_words")).alias("containment")))


def length_classes(templates: dict[str, str]) -> dict[int, dict[str, str]]:
    """Templates by window step: STEP for short notices, then its multiples by eight."""
    out: dict[int, dict[str, str]] = {}
    for name, text in templates.items():
        step = STEP
        while len(text.split()) > step:
            step *= 8
        out.setdefault(step, {})[name] = text
    return out


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, threshold: float = 0.8,
         telling: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.
    ``templates`` may be of any length (default: notices and whole texts)."""
    phrases, templates, telling = phrases or PHRASES, templates or TEMPLATES | BODIES, TELLING if telling is None else telling
    words = worded(docs)
    at = {name: f"p{k}" for k, name in enumerate(phrases)}
    base = words.select("doc_id", "h", F.size("words").cast("long").alias("n_words"),
                        *(places(F.col("words"), p.split()).alias(c) for p, c in at.items()))
    every = F.concat(*at.values())
    base = base.select("doc_id", "h", "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                       F.array_compact(F.array(*(F.when(F.size(c) > 0, F.lit(phrases[p])) for p, c in at.items()))).alias("base"))
    blocks = reduce(DataFrame.unionByName, [similar_blocks(words, own, threshold, step, telling) for step, own in sorted(length_classes(templates).items())])
    found = (blocks.groupBy("doc_id", "h")
             .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"), F.countDistinct("block").alias("n_blocks")))
    f = found.select(F.col("doc_id").alias("f_id"), F.col("h").alias("f_h"), "more", "best", "n_blocks")
    none = F.array().cast("array<string>")
    joined = base.join(f, base["doc_id"].eqNullSafe(f["f_id"]) & (base["h"] == f["f_h"]), "left")
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", text(F.col("base")).alias("base_labels"),
        text(F.concat("base", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))
