import pytest
from pyspark.sql import functions as F

from quire.functions import text as X


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("value,want", [
    ("a\n1\n2\nb", "a\n2\nb"), (" 　x\x1c", "x"), ("a   b", "a b"), ("a\n\n\n\nb", "a\n\nb"), ("<b>x</b>", "x"), ("see www.some-site.com now", "see  now"),
    ("Copyright 2020 by us\nnext", "next"), ("ALL  RIGHTS reserved.", "."), ("", ""), (None, None), ("x\n１２\ny", "x\ny"),
])
def test_clean_text(spark, value, want):
    assert one(spark, value, X.clean_text) == want


@pytest.mark.parametrize("path,good", [("images/a.jpg", True), ("a.PNG", True), (".jpg", False), ("a/.jpg", False), ("images/", False), ("a.jpg ", False), ("a.jpg\n", False), ("", False), (None, False)])
def test_image_paths(spark, path, good):
    assert one(spark, path, X.is_image_path) is good


@pytest.mark.parametrize("title,skip", [("Contents", True), ("  Table of  contents", True), ("Table of Contents ", True), ("Rev. B changes", True), ("Revision\nHistory", True), ("Scope", False), ("", False), (None, False)])
def test_skip_titles(spark, title, skip):
    assert one(spark, title, X.skips_section) is skip


def test_identity(spark):
    name = "My Doc.pdf-0123abcd-0123-0123-0123-0123456789ab"
    assert one(spark, name, X.doc_title) == "My Doc"
    assert one(spark, name, X.doc_id).startswith("My Doc_") and len(one(spark, name, X.doc_id)) == len("My Doc_") + 8


def test_html_rows(spark):
    rows = one(spark, '<tr><td>a</td><th> b </th></tr><tr></tr><tr><td colspan="2">x</td><td>c<br>d</td></tr>', X.html_rows)
    assert rows == [["a", "b"], [], ["cd"]]


def test_relative_path(spark):
    assert one(spark, "/root/x/a.pdf", lambda c: X.relative_path(c, "/root/x")) == "a.pdf"
    assert one(spark, "c\\d.pdf", lambda c: X.relative_path(c, "")) == "c/d.pdf"
    assert one(spark, None, lambda c: X.relative_path(c, "/r")) == ""
