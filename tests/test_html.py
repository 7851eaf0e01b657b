import pytest
from conftest import MENU, STARTER
from pyspark.sql import functions as F

from wordloom.functions.html import decode_entities, html_body_text, html_title


def run(spark, html, expr):
    return spark.createDataFrame([(html,)], "v string").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "html, title, body",
    [
        (MENU, "Menu & prices", "Rye loaf Oat loaf small large Dough by the kilo"),
        (STARTER, "Dough from a sour starter", 'Feed it daily Flour & water, "nothing else"'),
        ("<p>no <b>ti</b>tle", "", "no title"),
        ("<body><p>a</p><p>b<br>c</p>d<img src=x>e</body>", "", "a b c de"),
        ('<title>t</title><body class="x>y">in</body>out', "t", "inout"),
        ('<script>var t="</p>";</script><body>a<script>b</script>c<!-- <p>x</p> -->d</body>', "", "a cd"),
        ("<style>p{}</style><body>a < b &lt;i&gt; <", "", "a < b <i> <"),
        ("<body>x <p unfinished", "", "x"),
        ("<BODY>A&nbsp;&nbsp;B\n\t C", "", "A B C"),
        ("<head><title>a\n b</title></head>text", "a b", "text"),
    ],
)
def test_pages(spark, html, title, body):
    assert run(spark, html, html_title) == title
    assert run(spark, html, html_body_text) == body


@pytest.mark.parametrize(
    "text, decoded",
    [
        ("&amp;lt; &amp &ampx; &copy; &eacute;", "&lt; & &ampx; © é"),
        ("&#65;&#x42;&#X1F600; &#0; &#xD800; &#99999999;", "AB😀 � � �"),
        ("AT&T & co &unknown; &;", "AT&T & co &unknown; &;"),
        ("plain", "plain"),
    ],
)
def test_entities(spark, text, decoded):
    assert run(spark, text, decode_entities) == decoded


def test_zero_padded_references(spark):
    from pyspark.sql import functions as F

    from wordloom.functions.html import decode_entities

    text = "&#" + "0" * 60 + "65;&#x" + "0" * 60 + "42;&#99999999999999;&#0;"
    assert spark.range(1).select(decode_entities(F.lit(text)).alias("t")).first().t == "AB��"
