import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import normalize as N
from lakeloom.functions import similarity as S


def values(spark, f, items):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "f, cases",
    [
        (N.clean_text, {"Hello, World!": "hello world", "Café": "cafe", "  Extra   Spaces  ": "extra spaces", None: "", "a_b": "a_b", "Acme™ №5": "acmeTM No5", "Straße Ørsted Łódź": "strae rsted odz", "": ""}),
        (N.normalize_name, {"Acme Corp LLC": "acme", "Widgets Incorporated": "widgets", "Big Business DBA Small Shop": "small shop", "x dba dba y": "dba y", "inc corp": "", "co": "", "acmeco": "acmeco", "taco co op": "taco co op", "L.L.C.": "l l c", "co acme inc": "co acme", "a doing business as b inc": "b", "dba x": "dba x", None: ""}),
        (N.normalize_address, {"123 Main Street Suite 4": "123 main st ste 4", "456 North Avenue": "456 n ave", None: "", "": ""}),
        (N.normalize_country, {"United States": "us", "U.S.A.": "us", "Great Britain": "gb", "UnknownLand": "unknownland", None: ""}),
    ],
)
def test_normalization(spark, f, cases):
    assert values(spark, f, list(cases)) == list(cases.values())


def test_clean_text_of_random_unicode(spark):
    r = random.Random(5)
    pool = [chr(c) for c in [*range(32, 0x250), *range(0x1E00, 0x1F00), 0xFB01, 0x2122, 0x2116, 0x2460, 0x1D400, 0x3042, 0x1F600] if not 0xD800 <= c < 0xE000]
    items = ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(300)]

    def plain(x):
        folded = unicodedata.normalize("NFKD", x.lower()).encode("ascii", "ignore").decode()
        return " ".join(re.sub(r"[^\w\s]", " ", folded).split())

    assert values(spark, N.clean_text, items) == [plain(x) for x in items]


def test_tokens_and_ngrams(spark):
    assert values(spark, N.tokens, ["a b a", "", None]) == [["a", "b"], [], []]
    assert values(spark, lambda c: N.char_ngrams(c, 3), ["ab", "acme acme", None]) == [[], ["acm", "cme", "mea", "eac"], []]


def test_similarities(spark):
    pairs = [("acme", "acme"), ("acme", "widgets"), ("", "x"), (None, "x"), ("a b", "b c"), ("tide", "diet"), ("diet", "tide"), ("ab " * 100, ("ab " * 100)[1:]), (" ", "a")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select("i", S.exact_match(a, b).alias("e"), S.jaccard(a, b).alias("j"), S.seq_ratio(a, b).alias("s"), S.agreement(a, b).alias("g")).orderBy("i").collect()
    assert [r.e for r in got[:5]] == [1, 0, 0, 0, 0]
    assert [r.j for r in got[:5]] == [1, 0, 0, 0, pytest.approx(1 / 3)] and got[8].j == 0
    assert [r.g for r in got[:5]] == [1, 0, -1, -1, 0]
    for r, (x, y) in zip(got, pairs, strict=True):
        assert r.s == (SequenceMatcher(None, x, y).ratio() if x and y else 0)
    assert (got[5].s, got[6].s, got[7].s) == (0.25, 0.5, 0.0)
