"""Invented prose and small helpers for tests outside tests/llm."""

from __future__ import annotations

import hashlib
import random

WORDS = "river stone market window garden letter bridge morning engine harbour winter candle forest paper silver meadow captain journey kitchen teacher village thunder pocket ladder basket copper orchard whisper lantern pebble shadow velvet saddle marble timber walnut ribbon anchor summit canyon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (rng.choice([".", "!", "\n"]) if k % 12 == 11 else "") for k in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def noted(seed: int, key: object) -> str:
    """The place of a key in a seeded order."""
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()
