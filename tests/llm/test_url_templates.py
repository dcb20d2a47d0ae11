from __future__ import annotations

import pytest

from tradelake.llm import url_templates

SCHEMA = "page_id bigint, url string, html string, host string, path string, rule string"


def judged(spark, urls, **options):
    pages = spark.createDataFrame([(i, u, "h", "x", "y", "z") for i, u in enumerate(urls)], SCHEMA)
    return {row.row.page_id: row for row in url_templates.judge(pages, **options).collect()}


def test_rules_and_parts(spark):
    cases = [
        ("http://EXAMPLE.com/en/1?x#y", "example.com", "/en/1", "example.com/en/", "block"),
        ("http://a.www.example.com/en/1", "a.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://example.com/de/1", "example.com", "/de/1", "com/", "allow"),
        ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        ("ftp://x.net/es/", "x.net", "/es/", "net/es/", "block"),
        ("ftp://x.net/es", "x.net", "/es", None, "allow"),
        ("ftp://x.com", "x.com", "", None, "allow"),
        ("http://com/", "com", "/", "com/", "allow"),
        ("http://X.ORG?u=http://b.com/", "x.org", "", None, "allow"),
        ("no scheme.com/en/", "", "", None, "allow"),
        ("a://b://c.com/", "b:", "//c.com/", None, "allow"),
        ("http://ÉCOM.com/", "Écom.com", "/", "com/", "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    found = judged(spark, [c[0] for c in cases])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        row = found[i]
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_templates_learn_from_ruled_pages(spark):
    """Pages beside blocked ones go the same way; pages of another kind do not."""
    rules = (("x.org/ads/a", "block"), ("x.org/news/a", "allow"))
    urls = [f"http://x.org/ads/a{i}" for i in range(20)] + ["http://x.org/ads/a99.html"]
    urls += [f"http://x.org/news/a{i}" for i in range(20)]
    urls += ["http://x.org/ads/b7", "http://x.org/other/5", "http://x.org/news/b7"]
    found = judged(spark, urls, rules=rules)
    assert [found[i].rule is None for i in (41, 42, 43)] == [True] * 3
    assert found[0].template != found[21].template
    assert [found[i].verdict for i in (0, 21, 42, 43)] == ["block", "allow", "allow", "allow"]


def test_variable_segments(spark):
    urls = [f"http://x.org/{name}/{i}" for i, name in enumerate("abcdefghijklmnop")]
    urls += ["http://x.org/0123456789abcdef0/1", "http://x.org/00000000-0000-0000-0000-000000000000/1"]
    found = judged(spark, urls)
    assert len({found[i].template for i in range(16)}) == 1
    assert found[16].template == found[17].template


def test_alike_branches_merge_and_others_do_not(spark):
    rules = (("x.org/bada", "block"), ("x.org/badb", "block"))
    urls = []
    for branch in ("bada", "badb", "finea", "fineb"):
        urls += [f"http://x.org/{branch}/{i}" for i in range(30)]
    urls += [f"http://x.org/files/{i}.pdf" for i in range(30)]
    found = judged(spark, urls, rules=rules)
    templates = {branch: found[30 * i].template for i, branch in enumerate(("bada", "badb", "finea", "fineb", "files"))}
    assert templates["bada"] == templates["badb"] == "/{like bada}/{n}"
    assert templates["finea"] == templates["fineb"]
    assert templates["files"] != templates["finea"]
    assert {found[i].verdict for i in range(60, 150)} == {"allow"}


def test_branches_that_differ_far_down(spark):
    """A rule on 11 of 30 pages of a branch blocks the others, and no page beside them."""
    rules = (("x.org/a/b/bad/p1", "block"), ("x.org/a/b/c/d/e/good/p", "allow"))
    urls = [f"http://x.org/a/b/bad/p{i}" for i in range(30)]
    urls += [f"http://x.org/a/b/good/p{i}" for i in range(30)]
    for name in ("good", "bad"):
        urls += [f"http://x.org/a/b/c/d/e/{name}/p{i}" for i in range(30)]
    found = judged(spark, urls, rules=rules)
    assert [found[i].verdict for i in range(30)] == ["block"] * 30
    assert {found[i].verdict for i in range(30, 120)} == {"allow"}
    assert {found[i].rule for i in (0, *range(30, 60))} == {None}
    assert found[0].template != found[40].template
    assert found[70].template != found[100].template


def test_the_rest_of_a_rare_branch_is_a_wildcard(spark):
    urls = [f"http://x.org/a/b/{i}x/y/z" for i in range(4)] + ["http://y.org/" + "d/" * 5000]
    urls += [f"http://x.org/k/l/m{i}" for i in range(5)]
    found = judged(spark, urls)
    assert {found[i].template for i in range(4)} == {"/a/{below}"}
    assert found[4].template == "/d/{below}"
    assert {found[i].template for i in range(5, 10)} == {"/k/l/m{n}"}


@pytest.mark.parametrize("n", [0, 1])
def test_few_pages(spark, n):
    assert len(judged(spark, ["http://a.org/x"] * n)) == n


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    url_templates.judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
