"""Documents with every odd case the operators define, and brute-force twins."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, size int, "
          "shard string, slot string, secrets string, fp string, copies int, taken int, text_key string, ident string")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices(["an", "the", "ri", "on", "sha", "le", "è", "ti"], k=r.randint(1, 4))) for _ in range(n))


def odd_rows() -> list[tuple]:
    near = prose(1, 300)
    texts = [
        None, "", " \n\t ", "one", "one two three", near, near, near + " tail", near.replace("the", "tha", 1),
        prose(2, 20_000), "x" * 50_000, "ｗide 文字 \U0001F600 text nbsp", prose(3, 50), prose(3, 50).upper(),
        'say password = "abcdef1234" and token:short ' + "0123456789abcdef" * 2 + " AKIA" + "Z9" * 9,
        "a  b \x0b c\r\nd", "<turn user>\\</turn>",
    ] + [prose(100 + k, 30 + k) for k in range(12)]
    sources = [None, "", "a", "b", "ｂ", "a", "a", "a"]
    rows = [(k, t, None if k % 5 == 0 else "en", sources[k % len(sources)], None if k % 3 == 0 else len(t or ""),
             None, 7, "s", None, "x", "f", 3, None, "k", "i") for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[0]]                               # repeated rows
    rows += [(None, *rows[12][1:]), (None, *rows[20][1:])]            # without an id
    return rows


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def none(df):
    return df.limit(0)


def same_rows(a, b) -> bool:
    def key(r):
        return tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
