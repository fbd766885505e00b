"""Small tables with everything that may go wrong in a corpus."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Names that the operators use inside.
    " row_id long, score double, content string, h long, size int, key string, part int,"
    " label int, doc string, packed string, start int, seg string"
)


def phrase(random_, n):
    return " ".join("".join(random_.choices("abcdeno", k=random_.randint(1, 5))) for _ in range(n))


def rows(seed=1, nulls=True):
    """(doc_id, text, lang, source) with copies, near copies, shared passages and odd rows."""
    r = random.Random(seed)
    passage, second = phrase(r, 60), phrase(r, 40)
    found = []
    for i in range(24):
        found.append((3 * i, phrase(r, r.randint(1, 200)), r.choice(["en", "de"]), f"s{i % 4}"))
    base = phrase(r, 120)
    words = base.split()
    for i in range(8):
        near = list(words)
        near[r.randrange(120)] = "changed"
        found.append((100 + i, " ".join(near), "en", "s0"))
    found.append((110, base, "en", "s0"))
    found += [(200 + i, found[5][1], "en", "hot") for i in range(12)]
    found += [(300 + i, f"{phrase(r, 5)} {passage} {phrase(r, 5)}", "de", "hot") for i in range(6)]
    found.append((320, f"{second} {second}", "de", "s1"))
    found.append((321, "la " * 120, "de", "s1"))
    found.append((322, passage.upper(), "de", "s2"))
    found.append((323, "", "de", "s2"))
    found.append((324, " \t\n ", "de", "s2"))
    found.append((325, "x", "en", "s3"))
    found.append((326, "X", "en", "s3"))
    found.append((327, "Žluťoučký kůň 持続可能性 \U0001f600 é ß " * 9, None, "é"))
    found.append((328, phrase(r, 6000), "en", "s3"))
    found.append((329, "aa\n" * 700, "en", "s3"))
    if nulls:
        found += [(330, None, None, None), (None, "no key at all", "en", "s1")]
        found += [(None, None, None, None), (100, found[24][1], "en", "s0")]
    return found


def frame(spark, found):
    full = [
        (*one, len(one[1]) if one[1] is not None else None, 7, 0.5, "c", 1, 2, "k", 3, 4, "d", "p", 5, "s")
        for one in found
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
