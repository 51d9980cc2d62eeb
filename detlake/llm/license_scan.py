"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame functions only.

Blocks are windows over the words of a whole text, whatever its line ends, as published notices are wrapped. A template of n
words is sought in windows of twice `span` words that begin `span` words apart, span being the least of 8, 16, 32, ... from n on:
a notice of n words lies whole in one of them, and words scattered over a text do not add up to a notice.

Tokens are ordered by how often they occur in all documents, rarest first. A block contains a template if it holds at least
`num` / `den` of its distinct tokens, so at least `need`; then it holds one of the template's first size - need + 1 tokens
(prefix filter), has at least `need` tokens of templates (length filter), and from the places of the common token in both
orders enough tokens can still agree (positional filter). Pairs that pass are counted exactly. Only tokens of templates can
agree, so blocks are reduced to those; the index of template prefixes is as large as the template list, which is a parameter.

Beside it, phrases are found word by word. Words are runs of ASCII letters and digits and of all other characters beyond ASCII.

Defined cases: null and empty texts have no words, labels or score; long texts count whole; repeated rows get equal results; null
ids are kept; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from detlake.llm.columns import let, lower_ascii, starts, words

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc-by": ("cc", "by"), "gpl": ("general", "public", "license"), "reserved": ("all", "rights", "reserved")}
#: notices as published by the licenses' authors, as words
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-text": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-2.0-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl-text": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "no-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
    "public-domain": "this is free and unencumbered software released into the public domain",
}
NUM, DEN = 80, 100


def span(template: str) -> int:
    n = 8
    while n < len(template.split()):
        n *= 2
    return n


def _blocks(w: Column, step: int) -> Column:
    """Windows of 2 `step` words that begin `step` words apart."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(step)), lambda i: F.slice(w, i, 2 * step))


def template_tokens(templates: dict[str, str]) -> list[str]:
    return sorted({t for text in templates.values() for t in text.split()})


def token_counts(docs: DataFrame, tokens: list[str], text: str = "text") -> dict[str, int]:
    """How often each of a few given tokens occurs in all documents."""
    held = F.filter(words(lower_ascii(F.coalesce(F.col(text), F.lit(""))), BREAKS), lambda w: w.isin(tokens))
    counts = docs.select(F.explode(held).alias("token")).groupBy("token").count()
    return {r["token"]: r["count"] for r in counts.collect()}


def contained_templates(docs: DataFrame, templates: dict[str, str] = TEMPLATES, num: int = NUM, den: int = DEN, text: str = "text") -> DataFrame:
    """(tid, template, share): for each text (by its xxhash64) the templates that a block contains, with the largest share."""
    tokens = template_tokens(templates)
    counts = token_counts(docs, tokens, text)
    order = sorted(tokens, key=lambda t: (counts.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    sets = {name: sorted({*t.split()}, key=rank.__getitem__) for name, t in templates.items()}
    need = {name: -(-num * len(s) // den) for name, s in sets.items()}
    index = [(t, name, i, len(s), need[name]) for name, s in sets.items() for i, t in enumerate(s[:len(s) - need[name] + 1])]
    entries = F.array(*(F.struct(F.lit(t).alias("token"), F.lit(n).alias("template"), F.lit(span(templates[n])).alias("span"), F.lit(i).alias("i"), F.lit(size).alias("size"),
                                 F.lit(k).alias("need"), F.array(*(F.lit(x) for x in sets[n])).alias("own")) for t, n, i, size, k in index))
    spans = sorted({span(t) for t in templates.values()})
    prefixes = {n: sorted({t for t, name, *_ in index if span(templates[name]) == n}) for n in spans}
    least = {n: min(k for name, k in need.items() if span(templates[name]) == n) for n in spans}
    index = docs.sparkSession.range(1).select(F.inline(entries))

    def held(w: Column, n: int) -> Column:
        met = F.transform(F.filter(_blocks(w, n), lambda b: F.arrays_overlap(b, F.lit(prefixes[n]))), lambda b: F.array_intersect(F.lit(order), b))
        return F.transform(F.filter(met, lambda b: F.size(b) >= least[n]), lambda b: F.struct(F.lit(n).alias("span"), b.alias("block")))

    low = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    blocks = docs.select(F.xxhash64(text).alias("tid"), F.inline(let(words(low, BREAKS), lambda w: F.concat(*(held(w, n) for n in spans)))))
    pairs = blocks.select("tid", "span", "block", F.posexplode("block").alias("j", "token")).join(F.broadcast(index), ["token", "span"])
    room = F.least("i", "j") + 1 + F.least(F.col("size") - F.col("i") - 1, F.size("block") - F.col("j") - 1)
    pairs = pairs.where((F.size("block") >= F.col("need")) & (room >= F.col("need")))
    both = F.size(F.array_intersect("block", "own"))
    return pairs.where(both >= F.col("need")).groupBy("tid", "template").agg(F.max(both / F.col("size")).alias("share"))


def phrase_places(w: Column, low: Column, phrase: tuple[str, ...]) -> Column:
    """Starts of a phrase among the words w of the lower-cased text `low`."""
    def fits(i):
        return _all(F.get(w, i + k) == word if k else F.get(w, i) == word for k, word in enumerate(phrase))

    return F.when(_all(F.contains(low, F.lit(word)) for word in phrase), F.filter(starts(F.size(w), len(phrase)), fits)).otherwise(F.array().cast("array<int>"))


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def scanned(docs: DataFrame, phrases: dict[str, tuple[str, ...]] = PHRASES, templates: dict[str, str] = TEMPLATES, num: int = NUM, den: int = DEN, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (id, n_words, n_base, first_word, last_word, base_labels, labels, score). The score is 1
    where a phrase stands, else the largest share of a template that a block contains, else 0."""
    low = lower_ascii(F.coalesce(F.col(text), F.lit("")))

    def base(x):
        def found(w):
            places = F.struct(*(phrase_places(w, x, p).alias(f"p{i}") for i, p in enumerate(phrases.values())))
            return let(places, lambda p: F.struct(F.size(w).cast("long").alias("n_words"), F.concat(*(p[f"p{i}"] for i in range(len(phrases)))).alias("at"),
                                                  F.array_compact(F.array(*(F.when(F.size(p[f"p{i}"]) > 0, F.lit(name)) for i, name in enumerate(phrases)))).alias("names")))
        return let(words(x, BREAKS), found)

    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("tid"), let(low, base).alias("b")).select("id", "tid", "b.*")
    more = contained_templates(docs, templates, num, den, text).groupBy("tid").agg(F.collect_set("template").alias("templates"), F.max("share").alias("share"))
    rows = rows.join(more, "tid", "left")
    none = F.array().cast("array<string>")
    return rows.select(F.col("id").alias(id), "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
                       F.array_join(F.array_sort("names"), ",").alias("base_labels"),
                       F.array_join(F.array_sort(F.array_union("names", F.coalesce("templates", none))), ",").alias("labels"),
                       F.when(F.size("at") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
