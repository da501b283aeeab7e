"""Small tables with everything that a real one may hold."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASH = ["size", "fp", "hash", "score", "keep_id", "component", "target", "piece", "length", "rule", "words", "n", "p",
         "predicted", "label", "gram"]
WORDS = "the of and river stone light over under green salt paper wind north cold glass field road bread".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


def odd_rows():
    rows = [(k, prose(k, 20 + 3 * k), "en", f"s{k % 3}", 0) for k in range(1, 25)]
    rows += [(30, None, None, None, None), (31, "", "en", "s1", 0), (32, " \n\t ", "en", "s1", 3),
             (33, prose(3, 29), "en", "s2", 0), (34, prose(3, 29).replace(" ", "  "), "en", "s2", 0),
             (35, "alone", "en", "s0", 5), (36, prose(99, 30_000), "en", "s0", 0), (36, prose(99, 30_000), "en", "s0", 0),
             (None, prose(7, 12), "en", "s1", 0), (37, "café ÀB <|endoftext|> \x1c x", "fr", "s9", 0)]
    return rows


def odd_docs(spark, clash: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASH))) if clash else df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
