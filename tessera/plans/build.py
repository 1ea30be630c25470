"""Corpus and text builds: the preparation steps as Spark jobs.

* ``build_title_corpus``: a titles file -> numbered ``doc_id<TAB>title``
  corpus grown to a target size, plus the doc map of its base chunk.
* ``build_text``: a seeded generated text of a base size, grown to a target
  size by repetition.

Both write below ``out`` (plain folders of text part files, which the line
and corpus readers take as a whole) and return the paths and the plan used.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators.corpus import (
    corpus_stats, gen_text, number_corpus_file_order, plan_replication,
    plan_text_replication, replicate_corpus, replicate_lines, title_bytes)
from tessera.session import work_root
from tessera.sources.text import read_lines_positioned, write_lines, write_tsv_corpus

MB = 1024 * 1024


def build_title_corpus(spark: SparkSession, titles: str, out: str,
                       target_bytes: int | None = None,
                       part_bytes: int = 50 * MB) -> dict:
    """Numbered title corpus at ``out/input`` and its doc map at ``out/doc_map``.

    Without a target: one row per non-blank title, numbered in file order.
    With a target: the titles are repeated with fresh ids into a base chunk
    of about ``part_bytes``, and the chunk is copied with the same ids to
    reach ``target_bytes`` (``plan_replication``); the doc map lists the base
    chunk.
    """
    # reused three times below (sizes, two writes): written once
    numbered, n_titles = number_corpus_file_order(read_lines_positioned(spark, titles))
    numbered = numbered.checkpoint()
    if target_bytes is None:
        repeats, copies = 1, 1
    else:
        single = title_bytes(numbered, "content")
        repeats, copies = plan_replication(single, target_bytes, part_bytes)
    base = replicate_corpus(numbered, n_titles, repeats, 1).drop("copy")
    corpus = replicate_corpus(numbered, n_titles, repeats, copies).drop("copy")
    write_tsv_corpus(corpus, "doc_id", "content", f"{out}/input")
    write_tsv_corpus(base, "doc_id", "content", f"{out}/doc_map")
    return {"corpus": f"{out}/input", "doc_map": f"{out}/doc_map",
            "base_repeats": repeats, "num_copies": copies}


def build_text(spark: SparkSession, out: str, base_bytes: int = 2 * MB,
               target_bytes: int | None = None, seed: int = 42,
               min_part_bytes: int = 6 * MB) -> dict:
    """Generated text of ``base_bytes`` at ``out/input``, grown to ``target_bytes``.

    The base is repeated to at least ``min_part_bytes`` and that block copied
    ``round(target / block)`` times (``plan_text_replication``).
    """
    work_root(spark)                     # makes sure a checkpoint folder is named
    base = gen_text(spark, base_bytes, seed).checkpoint()   # sized, then copied
    if target_bytes is None:
        times = 1
    else:
        actual = corpus_stats(base).first()["n_bytes"]
        repeats, copies = plan_text_replication(int(actual), target_bytes, min_part_bytes)
        times = repeats * copies
    text = replicate_lines(base, times) if times > 1 else base
    write_lines(text, F.col("line"), f"{out}/input")
    return {"text": f"{out}/input", "times": times}
