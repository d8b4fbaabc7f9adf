"""Small tables with every awkward case, and plain versions of what the operators compute."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, lang string, id long, key string, n int, _id string, norm string, bucket int, kind int, base long"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def rows():
    """(doc_id, text, source): nulls, empty, blank and very long texts, copies, near copies, ties and repeated rows."""
    r = random.Random(5)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(300)]
    base = [" ".join(r.choice(vocabulary) for _ in range(60)) for _ in range(6)]
    out = []
    for i in range(40):
        words = base[i % 6].split()
        for _ in range(i // 12):
            words[r.randrange(len(words))] = f"edit{i}"
        out.append((i, " ".join(words), ["a", "b", None, "c"][i % 4]))
    out += [(100, None, "a"), (101, "", "b"), (102, " \n\t ", "b"), (103, "one two three", "c"), (104, "ONE two three", "c"), (105, "É one", "é"), (106, "é one", "é")]
    out += [(107, "x" * 50_000, "c"), (108, " ".join(r.choice(vocabulary) for _ in range(20_000)), "c"), (109, base[0], "a"), (109, base[0], "a"), (109, base[0], "a")]
    out += [(110, "don't they'll  go\n\n now <|endoftext|> 12³ 漢字😀!!", "d"), (None, "a null id here with words", "d"), (111, base[1].upper(), None)]
    return out


def table(spark, data=None, schema=SCHEMA):
    names = [x.split()[0] for x in schema.split(", ")]
    filler = {"lang": "en", "id": 7, "key": "k", "n": 1, "_id": "z", "norm": "?", "bucket": 3, "kind": 0, "base": 9}
    data = rows() if data is None else data
    return spark.createDataFrame([tuple(dict(zip(("doc_id", "text", "source"), x, strict=True)).get(c, filler.get(c)) for c in names) for x in data], schema).repartition(3)


def shingles(text):
    words = WORD.findall(lower(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def thue_morse(n=1024):
    """Two different texts that a polynomial hash modulo a power of two can't tell apart."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
