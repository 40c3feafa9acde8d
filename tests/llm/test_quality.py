import random
from collections import Counter

import pyarrow.parquet as pq
from helpers import docs_frame, same_rows

from tslake.llm import quality

GOOD = "Line%d of plain%d prose with own%d words that%d end as%d they%d should%d."
TEXTS = [
    None,
    "",
    " \n\t\n ",
    "\n".join(GOOD % ((i,) * 7) for i in range(8)),
    "\n".join([GOOD % ((i,) * 7) for i in range(8)] + ["Home | News | Sport | Contact"]),
    "\n".join([GOOD % ((i,) * 7) for i in range(8)] + ["Please accept cookies to go on reading this page."]),
    "\n".join(["a|b|c|d"] * 30 + [GOOD % ((1,) * 7)]),
    "a b c " * 40,
    "x " * 60,
    "STOP!! NOW!! " * 30,
    "same line here.\nsame line here.\n same line here.",
    "w " * 49,
    " ".join(f"w{i}" for i in range(50)) + ".",
    "é ñ " * 30,
    " ".join(f"n{i % 9000}" for i in range(40000)) + ".",
    " ".join(f"word{i}" for i in range(400)) + " and our privacy policy says more, as do the terms of use " + " ".join(f"word{i}" for i in range(400, 600)),
    " ".join(f"mot{i}" for i in range(200)) + " « un » puis « deux » puis « trois » puis " + " ".join(f"mot{i}" for i in range(200, 400)) + ".",
    "\n".join([GOOD % ((i,) * 7) for i in range(8)] + ["About us » Contact » News » Jobs and careers", "See our Privacy Policy."]),
]


def noise():
    rng = random.Random(3)
    return ["".join(rng.choice(["a ", "b ", "cc ", "\n", "#", "|", "! ", ". ", "\t", "é "]) for _ in range(rng.randint(0, 160))) for _ in range(150)]


def test_against_sql(spark):
    df, arrow = docs_frame(spark, TEXTS + noise())
    same_rows(quality.report(df), quality.SQL, documents=arrow)


def test_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    same_rows(quality.report(spark.read.parquet(path)), quality.SQL, documents=pq.read_table(path))


def test_repeats_against_brute_force(spark):
    df, _ = docs_frame(spark, TEXTS + noise())
    got = {r.doc_id: r.n_repeat_words for r in quality.report(df).collect()}
    for i, text in enumerate(TEXTS + noise()):
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = Counter(windows)
        assert got[i] == len({k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)})


def test_clean(spark):
    df, _ = docs_frame(spark, TEXTS)
    kept = {r.doc_id: r for r in quality.clean(df).collect()}
    assert quality.clean(df).columns == df.columns
    assert kept[3].text == TEXTS[3] and kept[4].text == TEXTS[3] and kept[5].text == TEXTS[3]
    assert not {0, 1, 2, 6, 7, 8, 9, 11} & set(kept) and 12 in kept and kept[3].kept == "clash"
    assert kept[15].text == TEXTS[15] and kept[16].text == TEXTS[16] and kept[17].text == TEXTS[3]
    assert quality.report(df.limit(0)).count() == 0
