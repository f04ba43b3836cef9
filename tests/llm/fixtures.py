"""Small tables with the awkward cases that every operator must bear."""

from __future__ import annotations

import random
from pathlib import Path

DATA = Path("/root/testdata")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, rank int, shard string, n string, component string, h string, key string, part string, start string, score string"
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work number night point home water room mother area money story fact month lot right study book eye job word business issue side kind head house service friend father power hour game line end member law car city community name president team minute idea kid body information back parent face others level office door health person art war history party result change morning reason research girl guy moment air teacher force education".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for k in range(n):
        w = rng.choice(WORDS)
        out.append(w.capitalize() if k % 11 == 0 else w)
        if k % 11 == 10:
            out[-1] += rng.choice([".", "!", ".\n", "?\n\n"])
    return " ".join(out)


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def rows(seed: int = 5, plain: int = 40, long_words: int = 30_000) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): prose, copies and near copies, odd characters, nulls, repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(3, 300)) for _ in range(plain)]
    base = prose(rng, 220)
    passage = prose(rng, 60)
    texts += [base] * 6 + [edited(rng, base, s) for s in (0.002, 0.005, 0.01, 0.01, 0.015, 0.02, 0.02, 0.03, 0.05, 0.1)]
    texts += [f"{prose(rng, 30)}\n{passage}\n{prose(rng, 30)}" for _ in range(8)]
    texts += ["", None, " \t\n\x0b\x0c\r ", "a", "a b c", "a b c d", "A B C D", "one two three four five", "x " * 500, "ab" * 800, "é" * 300, "日本語のテキスト、改行\nあり。 " * 20, "🙂👍🏽 emoji \U0001f468‍\U0001f469  nbsp em\x85nel\x1cfs\x00nul", "İstanbul ſharp ẞ Ǆ ﬁ ½ ² ٣ ͅ", "1234567 89.01 -- ''' it's I'll WE'VE don''t <|endoftext|> <|startoftext|>", "line\nline\nline\nother\nline", "\n\n\n", "https://www.example.com/a?b=c#d " * 12, "under the mit license", "Under the MIT License; apache license, version 2.0. (CC BY-NC 4.0)", "under the mit\nlicense under the mit license", "released under the MIT license by under the mit license"]
    texts.append(prose(rng, long_words))
    out = [(k, t, rng.choice(["en", "de", None]), rng.choice(["hot"] * 4 + ["a", "b", None]), len(t) if t is not None and k % 7 else None) for k, t in enumerate(texts)]
    rng.shuffle(out)
    return out


def clashing(spark, plain_rows: list[tuple]):
    """The same rows with further columns named as the operators name their own."""
    return spark.createDataFrame([(*r, "x", 1, *["y"] * 8) for r in plain_rows], SCHEMA)


def stored(spark, folder, plain_rows: list[tuple], partitions: int = 3) -> str:
    """The rows as the documents table of a data folder."""
    spark.createDataFrame(plain_rows, PLAIN).repartition(partitions).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)


def table_of(spark, sf_dir: str, name: str = "documents") -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
