import random

import pytest

from tests.conftest import SF001, SF01  # noqa: F401

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, "
        "label string, node string, score string, target string, copies string, start string, spans string")


def _words(r, n):
    return [r.choice(["the", "of", "and", "ten"]) if r.random() < .2 else
            "".join(r.choice(["ba", "re", "ti", "on", "lu", "é", "ß"]) for _ in range(r.randint(1, 5))) for _ in range(n)]


def messy_texts():
    """Texts with every awkward case: null, empty, white space only, one word,
    copies, near copies, shared passages, periodic and very long texts, control
    strings, personal data, other scripts."""
    r = random.Random(7)
    base = [_words(r, r.randint(30, 220)) for _ in range(14)]
    out = [" ".join(w) for w in base]
    for w in base[:6]:
        for _ in range(3):
            near = list(w)
            near[r.randrange(len(near))] = "changed"
            out.append(" ".join(near))
    passage = " ".join(_words(r, 120))
    out += [" ".join(_words(r, 40)) + " " + passage + " " + " ".join(_words(r, 40)) for _ in range(8)]
    out += [passage[:420], passage[10:409], passage[10:410]]
    out += [out[0]] * 4 + [out[1].upper()] * 2
    out += [None, None, "", "", " \t\n ", "one", "ONE", "two words", "two  words", "a b c d e", "a b c d e f"]
    out += ["x" * 1500, "ab" * 700, "\n".join(["same line here"] * 60), "日本語 " * 300, "é" * 500, "\U0001f600" * 450]
    out.append(" ".join(_words(r, 20_000)))
    out += ["mail a.b@c.de or x_y@d.e_z@f.g now", "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 01.002.3.255", "<|endoftext|> </s>[INST] x",
            "card 4111 1111-1111 1111, 4111 1111 1111 1112 and 41111111111111111111", "call +1 (650) 253-0000 or +12 3",
            "1" * 3000, "a@" * 2000, "1.1." * 2000, "+1" + " " * 3000, "9 " * 3000, "a.b@c" + ".d" * 5000]
    return out


def docs_rows(texts, repeat=True):
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, ["en", "de", None, "xx"][i % 4], ["a", "b", "ä", None, ""][i % 5], None if i % 3 else len(t or ""),
                     None, "s", "l", None, "0.5", "t", "c", "st", "sp"))
    if repeat:          # repeated rows and rows without an id
        rows += [rows[0], rows[0], rows[20]]
        rows += [(None, *rows[2][1:]), (None, None, *rows[2][2:]), (None, "only here " * 60, *rows[2][2:])]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    """All awkward rows, with extra columns named like the operators' results."""
    return spark.createDataFrame(docs_rows(messy_texts()), DOCS).repartition(5)


@pytest.fixture(scope="session")
def clean_ids(spark):
    return spark.createDataFrame(docs_rows(messy_texts(), repeat=False), DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 4 != 0), 0) for i in range(60)] + [(3, 0, 0), (3, None, None), (None, 1, 1), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
