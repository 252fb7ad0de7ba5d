import random

import pytest

from basketry import settings
from basketry.operators import search, serving
from basketry.plans import jobs
from basketry.sinks import tables as sink
from basketry.sources import tables

NAME = "productId bigint, name string, imageUrl string, categories string, tags string"
WORDS = ("spring", "green", "ring", "red", "orange", "(new)", "a+b", "富勒 鼠标", "😀😀😀x", "x")

PATTERNS = (
    "red|ring$",
    "^spring",
    "spring.*(blush|green)",
    "ora?nge?",
    "oranges?",
    "rangex{0,2}",
    "ra+nge",
    "ran+?ge",
    r"\(new\)",
    r"a\+b",
    r"\Qa+b\E",
    r"\x72ing",
    "(?i)RING",
    "(?:ri|gr)een",
    "gr[ae]en",
    "gre[^\\]]n",
    "[[a-g]&&[^e]]een",
    "富勒",
    "勒 鼠标",
    "😀😀😀",
    "ring|",
    "(spring|ring) green",
    "((r)ing)* red",
    "never seen|red",
    "never seen",
    ".",
    "",
)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    random.seed(5)
    made = [(n, " ".join(random.choices(WORDS, k=random.randint(1, 4)))) for n in range(400)]
    made += [(900, None), (901, ""), (902, "re"), (None, "spring ring"), (903, "red"), (903, "ring")]
    products = spark.createDataFrame([(n, name, "", "", "") for n, name in made], NAME)
    root = str(tmp_path_factory.mktemp("search"))
    sink.overwrite(products, root, settings.PRODUCT)
    jobs.search_index_job(spark, root)
    names = (settings.PRODUCT, settings.TRIPLES, settings.TRIPLE_COUNTS)
    return tuple(tables.read_table(spark, root, name) for name in names)


@pytest.mark.parametrize("pattern", PATTERNS)
def test_same_as_a_scan(index, pattern):
    products, posted, counts = index
    key = lambda r: (r["productId"] is None, r["productId"], r["name"])
    found = sorted(search.matching(products, posted, counts, pattern).collect(), key=key)
    assert found == sorted(products.where(products["name"].rlike(pattern)).collect(), key=key)


def test_candidates_are_few(index):
    products, posted, counts = index
    matches = products.where(products["name"].rlike("orange spring")).select("productId").distinct().count()
    likely = search.candidates(posted, counts, "orange spring").count()
    assert matches <= likely < products.count() / 3
    assert search.candidates(posted, counts, "never seen").count() == 0


@pytest.mark.parametrize("pattern", ("", ".", "ab", "abc|de", "(abc)", "(?i)abc", r"\x41bcd", "[[a]b]cde", "abc(", "a*bc"))
def test_patterns_that_scan(pattern):
    assert search.required_triples(pattern) is None


def test_triples_that_are_needed():
    assert search.required_triples("abcd|x.efg") == [{"abc", "bcd"}, {"efg"}]
    assert search.required_triples("abcd?ef+gh") == [{"abc"}]
    assert search.required_triples(r"ab\.c{2}") == [{"ab."}]


def test_average_is_joined(spark, index):
    averages = spark.createDataFrame([(903, 4.0)], "productId bigint, avg double")
    products, posted, counts = index
    found = search.search_products(products, averages, posted, counts, "^red$|^ring$").where("productId = 903")
    assert [r["score"] for r in found.collect()] == [4.0, 4.0]
    assert found.columns == serving.search_products(products, averages, "red").columns


def test_empty_table(spark, index):
    products, posted, counts = (df.limit(0) for df in index)
    assert search.matching(products, posted, counts, "ring").count() == 0
