import pytest
from pyspark.sql import functions as F

from rankdex.functions.literals import list_literal, normalise, related_entries
from rankdex.functions.numbers import lenient_long, prefix_long, strict_long
from rankdex.functions.porter import stem
from rankdex.functions.text import query_words, replace_first, stem_words, valid_query, words


def value(spark, given, function):
    df = spark.createDataFrame([(given,)], "c string")
    return df.select(function(F.col("c")).alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("['alt energy', \"women's work\"]", ["alt energy", "women's work"]),
        ("[]", []),
        (r"""['it\'s "x"']""", ['it\'s "x"']),
        (r"['a\xa0b']", ["a b"]),
        (r"['\xa0\xe9']", [" é"]),
        (r"['a\\x41']", [r"a\x41"]),
        ("['trail',]", ["trail"]),
        ("['in,]side', 'b']", ["in,]side", "b"]),
        ("['a' 'b']", None),
        (None, None),
    ],
)
def test_list_literal(spark, text, expected):
    assert value(spark, text, list_literal) == expected


@pytest.mark.parametrize(
    "text, expected, failed",
    [
        (
            """{865: 'Do schools kill', 12: "The world's 10 best"}""",
            {865: "Do schools kill", 12: "The world's 10 best"},
            False,
        ),
        ("{5: 'seven'}", {5: "seven"}, False),
        ("{3: 'a', 3: 'b'}", {3: "b"}, False),
        ("{3: 'b', 1: 'x', 3: 'a', 1: 'y'}", {1: "y", 3: "a"}, False),
        ("{}", {}, False),
        ("{'x': 'a'}", None, True),
        ("{1: 'a'", None, True),
        (None, None, False),
    ],
)
def test_dict_literal(spark, text, expected, failed):
    df = spark.createDataFrame([(text,)], "related string")
    row = normalise(df, maps=["related"]).first()
    assert (row["related"], row["related_parse_error"]) == (expected, failed)


def test_related_in_id_order(spark):
    df = spark.createDataFrame([(1, "{865: 'b', 12: 'a'}")], "doc_id long, related string")
    entries = related_entries(normalise(df, maps=["related"]), "doc_id", "related")
    assert [tuple(r) for r in entries.orderBy("place").collect()] == [
        (1, 0, 12, "a"),
        (1, 1, 865, "b"),
    ]


def test_normalise_all_columns(spark):
    df = spark.createDataFrame(
        [("['a']", "['x' 'y']", "https://www.site.com/www.site.com")], "t string, u string, url string"
    )
    out = normalise(df, lists=["t", "u"], hosts={"url": ("www.site.com", "embed.site.com")})
    row = out.first()
    assert out.columns == ["t", "u", "url", "t_parse_error", "u_parse_error"]
    assert (row["t"], row["t_parse_error"]) == (["a"], False)
    assert (row["u"], row["u_parse_error"]) == (None, True)
    assert row["url"] == "https://embed.site.com/www.site.com"


@pytest.mark.parametrize(
    "text, expected",
    [("a.b.b", "aXb.b"), ("none", "none"), ("", ""), (None, None), ("line\n.b", "line\nXb")],
)
def test_replace_first_is_literal(spark, text, expected):
    assert value(spark, text, lambda c: replace_first(c, ".", "X")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("12", 12), ("12abc", 12), (" 7", 7), ("-3x", -3), ("+4", 4), ("abc", None), ("", None),
        ("0x1F", 31), ("-0x10z", -16), ("0xg", None), ("0x", None), ("\t-0x1f", -31), ("\u00a07", 7), ("0x7fffffffffffffff", 2**63 - 1),
        ("0x8000000000000000", None), ("0x00000000000000000011", 17), ("x0x1", None), ("1 0x2", 1), ("9" * 30, None), (None, None),
    ],
)
def test_prefix_long(spark, text, expected):
    assert value(spark, text, prefix_long) == expected


@pytest.mark.parametrize("text", [" 7", "7 ", "", "x", "1.5", None, "9" * 30])
def test_strict_long_fails(spark, text):
    assert value(spark, text, lenient_long) is None
    with pytest.raises(Exception, match="not an integer"):
        value(spark, text, strict_long)


def test_strict_long(spark):
    assert value(spark, "-12", strict_long) == -12


@pytest.mark.parametrize(
    "text, expected",
    [
        ("solar power", True), ("co2", False), ("", False), ("l'été", False), (None, False),
        ("line\n", False), (" ", True),
    ],
)
def test_valid_query(spark, text, expected):
    assert value(spark, text, valid_query) is expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Solar  Power", ["solar", "power"]),
        (" a a ", ["a", "a"]),
        ("", []),
        (" ".join("abcdefghijklmnopqr"), list("abcdefghijklmno")),
        ("  " + " ".join("abcdefghijklmnop"), list("abcdefghijklmno")),
    ],
)
def test_query_words(spark, text, expected):
    assert value(spark, text, query_words) == expected


def test_words(spark):
    assert value(spark, "L'été, l'ÉTÉ\n2x", words) == ["l", "été", "x"]


@pytest.mark.parametrize(
    "word, expected",
    [
        # Published examples of the algorithm, per step.
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("caress", "caress"),
        ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
        ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"),
        ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
        ("conditional", "condit"), ("rational", "ration"), ("valenci", "valenc"),
        ("hesitanci", "hesit"), ("digitizer", "digit"), ("conformabli", "conform"),
        ("radicalli", "radic"), ("differentli", "differ"), ("vileli", "vile"),
        ("analogousli", "analog"), ("vietnamization", "vietnam"), ("predication", "predic"),
        ("operator", "oper"), ("feudalism", "feudal"), ("decisiveness", "decis"),
        ("hopefulness", "hope"), ("callousness", "callous"), ("formaliti", "formal"),
        ("sensitiviti", "sensit"), ("sensibiliti", "sensibl"), ("triplicate", "triplic"),
        ("formative", "form"), ("formalize", "formal"), ("electriciti", "electr"),
        ("electrical", "electr"), ("hopeful", "hope"), ("goodness", "good"),
        ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"),
        ("airliner", "airlin"), ("gyroscopic", "gyroscop"), ("adjustable", "adjust"),
        ("defensible", "defens"), ("irritant", "irrit"), ("replacement", "replac"),
        ("adjustment", "adjust"), ("dependent", "depend"), ("adoption", "adopt"),
        ("homologou", "homolog"), ("communism", "commun"), ("activate", "activ"),
        ("angulariti", "angular"), ("effective", "effect"), ("bowdlerize", "bowdler"),
        ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"),
        ("roll", "roll"),
        # Later changes, short words, y, and letters beyond a to z.
        ("archaeology", "archaeolog"), ("possibly", "possibl"), ("is", "is"), ("yes", "ye"),
        ("saying", "sai"), ("toy", "toi"), ("été", "été"), ("", ""),
    ],
)
def test_stem(word, expected):
    assert stem(word) == expected


def test_stem_words_keeps_shape(spark):
    df = spark.createDataFrame(
        [(1, ["cats", "cat", None]), (2, None), (3, []), (4, ["ponies"])], "k int, w array<string>"
    ).coalesce(1)
    out = df.select("k", stem_words("w").alias("s")).orderBy("k").collect()
    assert [r["s"] for r in out] == [["cat", "cat", None], None, [], ["poni"]]


@pytest.mark.parametrize(
    "text",
    ["['a'] junk", "['a'], 5", "['a']]", "['a', ['b']]", "[{'b': 1}]", "['a']}", "['a'], \"end\": 1} ["],
)
def test_lists_are_read_whole_or_not_at_all(spark, text):
    assert value(spark, text, list_literal) is None
    assert value(spark, "['[', '{x}', '']", list_literal) == ["[", "{x}", ""]
    assert value(spark, "[1, 2.5, null]", list_literal) == ["1", "2.5", None]


def test_a_filter_does_not_copy_the_parsing_of_maps(spark):
    """Behind a filter every mention of the parsed map used to be a copy of its parsing."""
    texts = [(1, "{2: 'b', 1: 'a', 2: 'c'}"), (2, "{1: 'a'"), (3, None), (4, "{'x': 'a'}")]
    df = normalise(spark.createDataFrame(texts, "k int, m string"), maps=["m"])
    entries = related_entries(df.where(~F.col("m_parse_error")), "k", "m")
    assert sorted(tuple(r) for r in entries.collect()) == [(1, 0, 1, "a"), (1, 1, 2, "c")]
    # The result, the filter, and the one that Spark infers from posexplode; as map and by parts.
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("from_json") <= 6
