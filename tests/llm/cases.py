"""Small tables with the awkward cases, and brute-force versions of the operators' results."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import xxhash

#: Every name that an operator uses inside, as clashing extra columns.
CLASHES = ["fp", "digest", "text_key", "found", "row", "n_words", "score", "bucket", "rank", "row_id", "path", "votes", "label_id"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)

_rng = random.Random(5)
_WORDS = ["".join(_rng.choice("abcdefgh") for _ in range(_rng.randint(2, 7))) for _ in range(300)]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(_WORDS) for _ in range(n))


def texts() -> list[str | None]:
    shared = prose(120, 1)
    item = prose(14, 2)
    return [
        None, "", " \n\t ", "a", "One TWO", "One TWO three", prose(40, 3), prose(40, 3), prose(40, 3).upper(), shared + " " + prose(30, 4), prose(25, 5) + "\n" + shared, prose(3000, 6), "To " * 200,
        "x\n" * 50 + "y", "é ñ ü ß Ünïcödé — “quotes” 日本語テキスト " * 3, "tab\tand\x0bvertical nbsp　wide", "### $$$ %%% " * 10 + prose(30, 7), prose(20, 8) + " " + item + " " + prose(20, 9), item, item + " " + item,
        "password=ce0d4d24e1d5c8b317 and token = \"1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae\" " + prose(10, 10), "<|endoftext|> in a text", "a" * 3000, "퟿ edge \U0001f600 emoji", "null\x00byte",
    ]


def documents(spark, extra: bool = True, rows: list | None = None):
    found = [(i, t, ["en", "de", None][i % 3], f"src{i % 2}", len(t or "")) for i, t in enumerate(texts())] if rows is None else rows
    found = [*found, *found[5:9], (None, "no id here at all", None, None, None), (None, None, None, None, None)] if rows is None else found
    schema = SCHEMA if extra else SCHEMA.split(", fp")[0]
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHES)) if extra else r for r in found], schema)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, n: int = 25):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(n)] + [(3, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 0)], "doc_id bigint, quality int, toxic int")


def benchmark(spark):
    item = prose(14, 2)
    return spark.createDataFrame([(1, item), (2, item), (10, "One, two. THREE"), (3, None), (4, "... !!!"), (None, prose(12, 3)), (1, item)], "item_id bigint, text string")


def fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(ids: list, fps: list[int], radius: int = 3) -> list:
    """The smallest id (nulls last) that each row reaches."""
    parent = list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                parent[root(a)] = root(b)
    least: dict[int, int | None] = {}
    for i, d in enumerate(ids):
        r = root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [least[root(i)] for i in range(len(fps))]


def rule_numbers(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {p for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def contaminated(text: str | None, items: dict, width: int = 10) -> tuple[int, int, list[str]]:
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, names = split(text), set(), set()
    for name, content in items.items():
        w = split(content)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[i : i + n]:
                    hit.update(range(p, p + n))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


def crc(ids) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
