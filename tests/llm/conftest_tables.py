"""Small tables with the awkward cases: nulls, empty and long texts, ties, clashing columns."""

import random

SF001 = "/root/testdata/sf0.001"
# Names that the operators use inside; the tables carry them as extra columns.
CLASH = ("row", "k", "t", "id", "fp", "batch", "part", "seq", "w", "th", "ids", "n_words", "kept", "shard", "token", "text_hash", "component_id")


def _texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(80)
    near = base.split()
    near[11] = "other"
    return [
        None, None, "", "", " \t\n ", "one", "two words", "Three little Words",
        base, base, " ".join(near), base.upper(), prose(9), prose(10), prose(34), prose(35),
        passage, prose(20) + " " + passage + "\n" + prose(5), passage + " " + passage,
        "run " * 40, "run " * 36, "a b " * 60, "x" * 100_000, "é" * 3000 + " " + "ß" * 700,
        "line one here\nline one here\n\nline two # * $ % & | < >\n\u00a0\n", "tab\tand\x0bvertical\x0cfeed\rreturn",
        "Unicode \u2003 spaces\u3000and \U0001F389 emoji \x1c file separators", "don't I'll we've 's 12a3 !!?? it's--that (word's)",
        prose(30_000), "the " + prose(200) + " the benchmark item says that seven plus five is twelve every day of the week " + prose(3),
        "THE BENCHMARK ITEM SAYS THAT SEVEN PLUS FIVE IS TWELVE EVERY", "short item", "a short item here",
        "tokens <|endoftext|>and<|endoftext|> inside a text", "\u2581\u2581 lower \u2581bar  two   three    spaces ", "Stop here. stop here, stop here! " * 20,
    ]


def _clash(df):
    from pyspark.sql import functions as F
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(f"x{i}"))
    return df


def edge_tables(spark, d):
    texts = _texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(8, texts[8]), (8, texts[8]), (5, "other text under a used id"), (None, texts[8]), (None, None), (None, "some null id")]
    langs = ("en", "en", "de", None, "", "en", "und")
    docs = [(k, t, langs[n % 7], f"src{n % 3}" if n % 5 else None, None if t is None else len(t)) for n, (k, t) in enumerate(rows)]
    _clash(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)).write.parquet(f"{d}/documents.parquet")
    items = [(1, "The benchmark item says that seven plus five is twelve every day of the week"), (2, "short item"), (3, None), (4, ""), (5, "SHORT ITEM"),
             (None, "benchmark item says that seven plus five is twelve every"), (7, "words that are nowhere at all in any of the documents here"), (7, "three")]
    _clash(spark.createDataFrame(items, "item_id long, text string")).write.parquet(f"{d}/benchmark.parquet")
    labels = [(i, 0 if i % 4 == 0 else 1, 0) for i in range(len(texts))] + [(5, 0, 1), (None, 1, 0), (6, None, 0)]
    _clash(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).write.parquet(f"{d}/labels.parquet")
    big, urls = "<p>" + "payload " * 300 + "</p>", [
        None, "", "no scheme", "http://", "https://Example.COM/en/1", "https://www.example.com/en/2?x#y", "http://a.example.com/EN/3", "http://b.net/es/4",
        "http://b.net/fr/", "http://b.net/fr", "ftp://c.org?q", "http://d.com#f", "http://x.y/z://w/en/", "http://b.net/es/4", "http://mexample.com/en/1",
    ]
    pages = [(i, u, None if i % 7 == 0 else big if i % 3 == 0 else f"<p>{i}</p>") for i, u in enumerate(urls * 3)]
    pages += [(6, urls[4], big), (6, urls[4], big), (None, urls[4], big), (None, None, None)]
    _clash(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)).write.parquet(f"{d}/pages.parquet")
    return d


def empty_tables(spark, d):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"),
                         ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string")):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return d
