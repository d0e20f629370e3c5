"""Small tables with awkward rows, and plain versions of what the operators compute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WORDS = "the of tion and éler über THE it's 12 x.y ñandú ### a&&& |".split()
CLASHES = "ids string, n_tokens string, words string, kept string, digest string, rep string, __text string, length string, sequence_id string"


def prose(seed: int, n: int) -> str:
    state, out = seed * 7919 + 13, []
    for k in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(state >> 33) % len(WORDS)] + chr(97 + (state >> 40) % 26) * ((state >> 50) % 3))
        if k % 17 == 16:
            out[-1] += "\n"
    return " ".join(out)


def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, control strings, very long ones, repeated rows, a row without a key."""
    rows: list[tuple[int | None, str | None]] = [
        (0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "Two words"), (5, "<|endoftext|>a <|startoftext|> b"),
        (6, "x" * 5000), (7, prose(7, 6000)), (8, "ΑΣ σς ﬁ é 中文 １２ 👩‍👩‍👧 İ\x1c\x85 z"), (9, "same text here"), (9, "same text here"),
        (None, "no key"), (10, "áb\r\n\r\nc\x0bd"), (11, prose(11, 40) + "\n" + prose(11, 40)),
    ]
    base = prose(3, 120).split(" ")
    for k in range(8):
        copy = list(base)
        copy[10 * k] = f"changed{k}"
        rows.append((20 + k, " ".join(copy)))
    rows += [(30, rows[-1][1]), (31, " ".join(base))]
    return rows


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]] | None = None) -> DataFrame:
    """With the columns of ``documents`` and others whose names clash with results."""
    rows = texts() if rows is None else rows
    extra = len(CLASHES.split(","))
    return spark.createDataFrame(
        [(i, t, "en", None, len(t or ""), *["clash"] * extra) for i, t in rows],
        f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHES}")


def shingles(text: str | None, k: int) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))) if words else frozenset()


def groups(rows: list[tuple[int, str | None]], k: int, num: int, den: int) -> dict[int, int]:
    """The smallest key each key reaches, comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}
