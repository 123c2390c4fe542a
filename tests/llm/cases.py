"""Tables with every awkward row that the operators promise to handle."""

import random

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30000))


def prose(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "river", "stone", "Garden", "été", "über", "light", "42", "it's", "don't", "night,"]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "ing", "s", "."]) for _ in range(n))


def awkward_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    base = prose(1, 80)
    texts = [(1, base), (2, base.upper()), (3, base), (3, base), (4, None), (5, ""), (6, " \n\t "), (7, LONG),
             (8, LONG + " end"), (9, "<|endoftext|> and <|endoftext|><|endoftext|>"), (10, "a" * 5000),
             (11, "one two three"), (12, "One two THREE"), (13, base.replace("river", "lake", 1)), (14, "😀 日本語 é́"),
             (None, "no id"), (None, None), (15, "É" + base), (16, "é" + base), (17, base + " x\x1cy\x85z\xa0w")]
    texts += [(100 + i, prose(i, 40 + i)) for i in range(20)]
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, b"x", "k", 0.5, 7, "r", [1], "n", 3) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, "
                                 "digest binary, key string, score double, row bigint, root string, ids array<int>, "
                                 "name string, copies int")


def awkward_pages(spark):
    canonical = '<html><head><link rel="canonical" href="%s"></head></html>'
    rows = [
        (1, "http://bad.example.net/x/1", None), (2, "https://Alias.example.org/en/2?a=1#top", canonical % "http://bad.example.net/x/1"),
        (3, "http://alias2.example.org/en/3", "<LINK REL='canonical' HREF='https://alias.example.org/en/2?a=1'>"),
        (4, "http://www.example.net/en/4", canonical % "http://bad.example.net/x/1"),
        (5, "http://fr.example.org/fr/5", canonical % "http://bad.example.net/x/1"),
        (6, "http://alone.example.org/en/6", '<meta http-equiv="refresh" content="0; url=/en/7">'),
        (7, "http://alone.example.org/en/7", "<link rel=stylesheet href=http://bad.example.net/x/1>"),
        (8, None, canonical % "http://bad.example.net/x/1"), (9, "no scheme", "<p>"), (10, "", None),
        (11, "http://net", None), (12, "http://net/", None), (13, "http://notnet/", None), (14, "HTTP://EXAMPLE.COM/de/", ""),
        (15, "http://moved.example.org/a/b", "<meta content='5;URL=http://shop.example.com/de/1&amp;x' http-equiv=refresh>"),
        (16, "http://moved.example.org/a/b", None), (16, "http://moved.example.org/a/b", None),
        (17, "http://loop.example.org/", canonical % "http://loop.example.org/"), (None, "http://x.example.net/en/", None),
        (18, "http://rel.example.org/d/one", canonical % "two"), (19, "http://rel.example.org/d/two", canonical % "//bad.example.net/q"),
        (20, "http://js.example.org/", canonical % "javascript:void(0)")]
    return spark.createDataFrame([(*r, "h", "rule", True) for r in rows],
                                 "page_id bigint, url string, html string, host string, rule string, hit boolean")


def awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i * 25, [((i * 37 + j * 11) % 19 - 9) / 16 for j in range(6)]) for i in range(60)]
    rows += [(2000, [0.5] * 6)] + [(2001 + i, [0.5] * 6) for i in range(30)] + [(2000, [0.5] * 6)]
    rows += [(3000, None), (3050, [nan] * 6), (3100, [inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (3150, [None] * 6), (3200, []),
             (3250, [0.25]), (None, [0.9] * 6)]
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id bigint, embedding array<float>, row int, score double")


def awkward_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, None), (3, 1, 0), (100, 0, 1), (101, 1, 0), (102, None, 0),
                                  (None, 1, 0), (103, 5, 0), (104, 0, 0)], "doc_id bigint, quality int, toxic int")


def write_tables(spark, path, empty=False):
    tables = {"documents": awkward_documents(spark), "pages": awkward_pages(spark), "embeddings": awkward_vectors(spark),
              "labels": awkward_labels(spark)}
    for name, df in tables.items():
        (df.limit(0) if empty else df).write.parquet(f"{path}/{name}.parquet")
