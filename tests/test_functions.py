import hashlib

import pytest
from pyspark.sql import functions as F

from quillstone.functions import text as T


def one(spark, f, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


CASES = [
    (T.iso_date, "20/05/2024", "2024-05-20"), (T.iso_date, "06 Dec 2024", "2024-12-06"), (T.iso_date, "", ""), (T.iso_date, "sometime in 2024", ""), (T.iso_date, "1/2/2023", "2023-02-01"),
    (T.iso_date, "31/02/2024", ""), (T.iso_date, "5 March 2021", "2021-03-05"), (T.iso_date, " 06  Dec  2024 ", "2024-12-06"), (T.iso_date, "3.4.2020", "2020-04-03"), (T.iso_date, None, ""),
    (T.joint_id_of, "DORA 137 - 3195", "DORA137"), (T.joint_id_of, "3308 - DORA221", "DORA221"), (T.joint_id_of, "3195", ""), (T.joint_id_of, "2787 - dora 011", "DORA011"), (T.joint_id_of, "XYZ 12", "XYZ12"),
    (T.act_ref, "Regulation (EU) No 575/2013", "575/2013"), (T.act_ref, "Directive 2013/36/EU", "2013/36"), (T.act_ref, "MiCA", ""), (T.act_ref, "Directive 2013/36/EU, see (EU) 2022/2554", "2013/36"),
    (T.slug_of, "DORA 137 - 3195", "dora-137-3195"), (T.slug_of, "__", ""), (T.clean_article, "Article 28", "28"), (T.clean_article, "N/A", ""), (T.clean_article, "28", "28"), (T.clean_article, "arts 3", "arts 3"), (T.clean_article, "art.  5(1)", "5(1)"),
    (T.act_family, "DORA-RTS-TPPol", "dora"), (T.act_family, "", "unsorted"), (T.act_family, "C R & D", "c-r-d"), (T.url_slug, "https://x/y/2734-dora003_en/", "2734-dora003"), (T.label_key, "Date of submission:", "date_of_submission"),
    (T.before_colon, "Status: a: b", "Status"), (T.after_colon, "Status: a: b", "a: b"), (T.after_colon, "none", ""), (T.strip_section_title, "EIOPA Answer : yes", "yes"), (T.strip_section_title, "Questionable", "Questionable"),
    (T.first_integer, "n 042 x 7", "042"), (T.html_escaped, 'a<b>&"', "a&lt;b&gt;&amp;&quot;"), (T.delisted_hash, "abc", "delisted:abc"), (T.delisted_hash, "delisted:abc", "delisted:abc"), (T.squash, "a  \n b", "a b"),
]


@pytest.mark.parametrize(("f", "value", "want"), CASES)
def test_vectors(spark, f, value, want):
    assert one(spark, f, value) == want


def test_ids(spark):
    assert one(spark, T.record_slug, "__", "http://u") == hashlib.sha1(b"http://u").hexdigest()[:12]
    assert one(spark, lambda t, n: T.format_joint_id(t, n.cast("int")), "dora", "3") == "DORA003"
    assert one(spark, lambda t, n: T.format_joint_id(t, n.cast("int")), "XYZ", "12") == "XYZ12"
    assert one(spark, lambda u: T.cache_bust(u, 7), "http://x?a=1") == "http://x?a=1&cachebust=7"
    assert one(spark, lambda _: T.epoch_ms_date(F.lit(1704067200001).cast("long")), "") == "2024-01-01"
    assert one(spark, lambda _: T.epoch_ms_date(F.lit(None).cast("long")), "") == ""
    assert one(spark, lambda _: T.days_before("2024-02-01T10:00:00Z", 14), "") == "2024-01-18"


def test_finalised(spark):
    f = lambda raw: one(spark, lambda c: T.finalised(c, F.lit("kept"), "2013/36"), raw).asDict()
    assert f("") == {"ref": "2013/36", "legal_act_ref": "(EU) 2013/36", "legal_act": "CRD"}
    assert f("MiCA") == {"ref": "", "legal_act_ref": "", "legal_act": "kept"}
    assert f("Regulation (EU) 2022/2554")["legal_act"] == "DORA"


@pytest.mark.parametrize("value", ['a "b" \\ c', "line\nnext\ttab", "", "é – ©", "\\n not a break", "x: y # z"])
def test_yaml_round_trip(spark, value):
    quoted = one(spark, T.yaml_quoted, value)
    assert "\n" not in quoted
    assert one(spark, lambda c: T.yaml_value(T.yaml_quoted(c)), value) == value


def test_links(spark):
    f = lambda *v: one(spark, T.candidate_links, *v)
    assert f("eba", "7309", "2025_7309 A title", "DORA170") == ["https://www.eba.europa.eu/single-rule-book-qa/qna/view/publicId/2025_7309"]
    assert f("esma", "2356", "", "")[0].endswith("/2356")
    assert f("esma", "x", "see 12 and 2356", "")[0].endswith("/2356")
    assert len(f("eiopa", "2734", "", "DORA003")) == 2
    assert f("eiopa", "DORA001-2622", "", "dora001")[0].endswith("/dora001-2622_en")
    assert f("other", "1", "", "") == [] and f("eba", "12", "none", "") == []
