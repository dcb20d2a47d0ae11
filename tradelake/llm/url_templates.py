"""URL filter: explicit rules, and a tree of path templates per host for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written

#: (rule, verdict): a host that holds for its subdomains too, then how the path begins.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts of a path that vary from page to page, and what stands for them.
VARIABLE = (
    (r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "{id}"),
    (r"[0-9a-fA-F]{16,}", "{id}"),
    (r"[0-9]+", "{n}"),
)
#: Where a path has ended; anything below a branch with too few pages.
END, BELOW = "{end}", "{below}"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The longest rule that fits (``value`` 0) or its verdict (1); null without one."""
    fitting = []
    for rule in sorted(rules, key=lambda rule: -len(rule[0])):
        name, slash, rest = rule[0].partition("/")
        fits = (host == name) | host.endswith("." + name)
        if slash:
            fits &= path.startswith(slash + rest)
        fitting.append(F.when(fits, F.lit(rule[value])))
    return F.coalesce(*fitting, F.lit(None).cast("string"))


def shape_of(path: Column) -> Column:
    for pattern, sign in VARIABLE:
        path = F.regexp_replace(path, pattern, sign)
    return path


def _merged(rows: DataFrame, keys: list[str], segment: str, rest: str) -> DataFrame:
    """``rows`` with ``segment`` replaced where branches of a node are alike.

    A branch is a node's child with all below it. The branches of one node with the
    same commonest label and commonest rest are pooled; a branch is alike when a G-test
    of its (rest, label) counts against the pool's stays within three standard
    deviations of what chance gives. Two or more alike become one branch, named after
    the first of them.
    """
    branch = [*keys, segment]
    counts = rows.groupBy(*branch, rest).agg(*[F.sum(c).alias(c) for c in ("allow", "block", "none")])
    totals = counts.groupBy(*branch).agg(
        F.sum("allow").alias("a"),
        F.sum("block").alias("b"),
        F.sum("none").alias("u"),
        F.max(F.struct(F.expr("allow + block + none").alias("n"), rest)).alias("most"),
    )
    totals = totals.select(
        *branch,
        (F.col("a") + F.col("b") + F.col("u")).alias("branch_n"),
        F.when(F.col("a") >= F.greatest("b", "u"), "allow")
        .when(F.col("b") >= F.col("u"), "block")
        .otherwise("none")
        .alias("label"),
        F.col("most")[rest].alias("main"),
    )
    labels = F.array(*[
        F.struct(F.lit(c).alias("kind"), F.col(c).alias("n")) for c in ("allow", "block", "none")
    ])
    cells = (
        counts.select(*branch, rest, F.inline(labels))
        .filter("n > 0")
        .join(totals, branch)
    )
    group = [*keys, "label", "main"]
    pool = cells.groupBy(*group, rest, "kind").agg(F.sum("n").alias("cell_n"))
    sizes = pool.groupBy(*group).agg(
        F.sum("cell_n").alias("pool_n"), (F.count("*") - 1).alias("free")
    )
    n = {name: F.col(name).cast("double") for name in ("n", "pool_n", "branch_n", "cell_n")}
    surprise = 2 * n["n"] * F.log(n["n"] * n["pool_n"] / (n["branch_n"] * n["cell_n"]))
    tested = (
        cells.join(pool, [*group, rest, "kind"])
        .join(sizes, group)
        .groupBy(*branch, "label", "main", "free")
        .agg(F.sum(surprise).alias("g"))
        .filter(F.col("g") <= F.col("free") + 3 * F.sqrt(2.0 * F.col("free")) + 1e-9)
    )
    several = tested.groupBy(*group).agg(F.count("*").alias("n"), F.min(segment).alias("first"))
    alike = tested.join(several.filter("n > 1").drop("n"), group).select(
        *branch, F.concat(F.lit("{like "), "first", F.lit("}")).alias("merged")
    )
    return (
        rows.join(alike, branch, "left")
        .withColumn(segment, F.coalesce("merged", segment))
        .drop("merged")
    )


def _grown(rows: DataFrame, support: int, variety: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with a column for each level of the tree, and these columns' names.

    Level by level, a path gives its next segment as long as at least ``support`` pages
    go on below the branch that it has come to; where fewer do, what is left of it is
    one wildcard. The tree ends where no branch goes on.
    """
    n = F.expr("allow + block + none")
    rows = rows.withColumn("parts", F.split("shape", "/", -1)).withColumn("state", F.lit("open"))
    steps: list[str] = []
    while True:
        step = f"s{len(steps) + 1}"
        steps.append(step)
        part = F.coalesce(F.try_element_at("parts", F.lit(len(steps) + 1)), F.lit(END))
        is_open = F.col("state") == "open"
        rows = rows.withColumn(
            step, F.when(is_open, part).when(F.col("state") == "cut", BELOW).otherwise(END)
        )
        rare = (
            rows.filter(is_open & ~F.col(step).contains("{") & (F.col(step) != ""))
            .groupBy("host", step)
            .agg(F.sum(n).alias("n"))
            .filter(F.col("n") < support)
            .select("host", step)
        )
        varied = rare.groupBy("host").count().filter(F.col("count") >= variety).select("host")
        rare = rare.join(varied, "host").withColumn("any", F.lit("{any}"))
        rows = rows.join(rare, ["host", step], "left")
        rows = rows.withColumn(step, F.when(is_open, F.coalesce("any", step)).otherwise(F.col(step)))
        goes_on = is_open & (F.size("parts") > len(steps) + 1)
        branch = ["host", *steps]
        support_of = rows.filter(goes_on).groupBy(*branch).agg(F.sum(n).alias("on"))
        rows = rows.drop("any").join(support_of, branch, "left")
        state = F.when(goes_on, F.when(F.col("on") >= support, "open").otherwise("cut")).otherwise("done")
        rows = written(rows.withColumn("state", state).drop("on"), "url-tree")
        if rows.filter("state <> 'done'").isEmpty():
            return rows.drop("parts", "state"), steps


def templates(
    paths: DataFrame, support: int = 5, variety: int = 10, prior: float = 1.0
) -> DataFrame:
    """The template of every (host, shape), and whether the template is rejected.

    ``paths`` has ``host``, ``shape``, ``label`` (allow, block or null), one row per
    page. Per host, the shapes form a tree of segments that goes as deep as branches
    have ``support`` pages below them; the rest of a path is one wildcard. Where a host
    and level have ``variety`` literal segments of fewer than ``support`` pages, these
    become a wildcard; alike branches merge, level by level. A template's purity is its
    share of allowed among labelled pages, smoothed by ``prior`` allowed and ``prior``
    blocked ones; below one half it is rejected, so a template without labels is not.
    Everything runs on counts per shape.
    """
    label = F.col("label")
    rows = paths.groupBy("host", "shape").agg(
        F.count(F.when(label == "allow", 1)).alias("allow"),
        F.count(F.when(label == "block", 1)).alias("block"),
        F.count(F.when(label.isNull(), 1)).alias("none"),
    )
    rows, steps = _grown(written(rows, "url-shapes"), support, variety)
    for k, step in enumerate(steps):
        # Ends in a slash, so that the order does not depend on how deep the tree is.
        below = F.concat_ws("/", *steps[k + 1 :], F.lit(""))
        rows = _merged(rows.withColumn("rest", below), ["host", *steps[:k]], step, "rest")
        rows = written(rows.drop("rest"), "url-tree")
    template = F.concat(F.lit("/"), F.concat_ws("/", *steps))
    rows = rows.withColumn("template", F.replace(template, F.lit(f"/{END}"), F.lit("")))
    purity = (F.sum("allow") + prior) / (F.sum("allow") + F.sum("block") + 2 * prior)
    judged = rows.groupBy("host", "template").agg(purity.alias("purity"))
    return rows.select("host", "shape", "template").join(judged, ["host", "template"])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, **options) -> DataFrame:
    """The verdict on every page's ``url``.

    A rule decides where one fits, the longest if there are several. Its pages are
    also the labels from which the template tree (:func:`templates`) learns; a page
    without a rule is blocked if its template is rejected.

    Columns: ``row`` (the page, all its columns), ``host``, ``path``, ``rule``,
    ``template``, ``purity``, ``verdict``. A null url, or one without ``://``, has an
    empty host and path and is allowed. Equal rows are judged alike; an empty table
    gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    found = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    found = found.select(
        "*",
        shape_of(F.col("path")).alias("shape"),
        rule_of(F.col("host"), F.col("path"), rules, 0).alias("rule"),
        rule_of(F.col("host"), F.col("path"), rules, 1).alias("label"),
    )
    known = written(templates(found.select("host", "shape", "label"), **options), "url-templates")
    verdict = F.coalesce("label", F.when(F.col("purity") < 0.5, "block").otherwise("allow"))
    return found.join(known, ["host", "shape"], "left").select(
        "row", "host", "path", "rule", "template", "purity", verdict.alias("verdict")
    )


def oracle_sql(levels: int = 6, support: int = 5, variety: int = 10) -> str:
    """The same verdicts in DuckDB SQL, for the table ``pages``, whose tree has at most
    ``levels`` levels."""

    def fits(rule: str) -> str:
        name, _, rest = rule.partition("/")
        return f"((host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}'))"

    ordered = sorted(RULES, key=lambda rule: -len(rule[0]))
    rule = " ".join(f"WHEN {fits(name)} THEN '{name}'" for name, _ in ordered)
    label = " ".join(f"WHEN {fits(name)} THEN '{verdict}'" for name, verdict in ordered)
    shape = "path"
    for pattern, sign in VARIABLE:
        shape = f"regexp_replace({shape}, '{pattern}', '{sign}', 'g')"
    steps = [f"s{k}" for k in range(1, levels + 1)]
    ctes = [
        f"""parsed AS (SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
        f"""found AS MATERIALIZED (SELECT *, {shape} AS shape, CASE {rule} END AS rule,
            CASE {label} END AS label FROM parsed)""",
        """t0 AS MATERIALIZED (SELECT host, shape, count(*) FILTER (label = 'allow') AS allow,
            count(*) FILTER (label = 'block') AS block, count(*) FILTER (label IS NULL) AS none,
            string_split(shape, '/') AS parts, 'open' AS state FROM found GROUP BY host, shape)""",
    ]
    last = "t0"
    for k, step in enumerate(steps, 1):
        branch = ", ".join(["host", *steps[:k]])
        ctes += [
            f"""a_{step} AS MATERIALIZED (SELECT *, CASE state WHEN 'open' THEN coalesce(parts[{k + 1}], '{END}')
                WHEN 'cut' THEN '{BELOW}' ELSE '{END}' END AS {step} FROM {last})""",
            f"""r_{step} AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY host) AS several
                FROM (SELECT host, {step} FROM a_{step} WHERE state = 'open' AND {step} <> ''
                AND NOT contains({step}, '{{') GROUP BY ALL
                HAVING sum(allow + block + none) < {support})) WHERE several >= {variety})""",
            f"""b_{step} AS MATERIALIZED (SELECT * EXCLUDE (several) REPLACE (CASE WHEN several IS NULL
                OR state <> 'open' THEN {step} ELSE '{{any}}' END AS {step})
                FROM a_{step} LEFT JOIN r_{step} USING (host, {step}))""",
            f"""g_{step} AS (SELECT *, state = 'open' AND len(parts) > {k + 1} AS goes_on FROM b_{step})""",
            f"""t_{step} AS MATERIALIZED (SELECT * EXCLUDE (goes_on) REPLACE (CASE WHEN NOT goes_on THEN 'done'
                WHEN sum(allow + block + none) FILTER (goes_on) OVER (PARTITION BY {branch}) >= {support}
                THEN 'open' ELSE 'cut' END AS state) FROM g_{step})""",
        ]
        last = f"t_{step}"
    for k, step in enumerate(steps):
        keys = ", ".join(["host", *steps[:k]])
        below = "concat_ws('/', " + ", ".join([*steps[k + 1 :], "''"]) + ")"
        c = f"m{k}"
        ctes += [
            f"""{c}_c AS MATERIALIZED (SELECT {keys}, {step}, {below} AS rest, sum(allow) AS allow,
                sum(block) AS block, sum(none) AS none FROM {last} GROUP BY ALL)""",
            f"""{c}_t AS MATERIALIZED (SELECT {keys}, {step}, sum(allow + block + none) AS branch_n,
                CASE WHEN sum(allow) >= greatest(sum(block), sum(none)) THEN 'allow'
                WHEN sum(block) >= sum(none) THEN 'block' ELSE 'none' END AS label,
                max({{'n': allow + block + none, 'rest': rest}}).rest AS main
                FROM {c}_c GROUP BY ALL)""",
            f"""{c}_u AS (SELECT {keys}, {step}, rest, 'allow' AS kind, allow AS n FROM {c}_c
                UNION ALL SELECT {keys}, {step}, rest, 'block', block FROM {c}_c
                UNION ALL SELECT {keys}, {step}, rest, 'none', none FROM {c}_c)""",
            f"""{c}_l AS MATERIALIZED (SELECT * FROM {c}_u JOIN {c}_t USING ({keys}, {step}) WHERE n > 0)""",
            f"""{c}_p AS (SELECT *, sum(n) OVER (PARTITION BY {keys}, label, main, rest, kind) AS cell_n,
                sum(n) OVER (PARTITION BY {keys}, label, main) AS pool_n FROM {c}_l)""",
            f"""{c}_f AS (SELECT {keys}, label, main, count(DISTINCT (rest, kind)) - 1 AS free
                FROM {c}_l GROUP BY ALL)""",
            f"""{c}_g AS (SELECT {keys}, {step}, label, main FROM {c}_p JOIN {c}_f USING ({keys}, label, main)
                GROUP BY {keys}, {step}, label, main, free HAVING sum(2.0 * n * ln(n::DOUBLE * pool_n
                / (branch_n::DOUBLE * cell_n))) <= free + 3 * sqrt(2.0 * free) + 1e-9)""",
            f"""{c}_a AS (SELECT {keys}, {step}, '{{like ' || first || '}}' AS merged FROM (SELECT *,
                min({step}) OVER (PARTITION BY {keys}, label, main) AS first,
                count(*) OVER (PARTITION BY {keys}, label, main) AS several FROM {c}_g) WHERE several > 1)""",
            f"""{c} AS MATERIALIZED (SELECT * EXCLUDE (merged) REPLACE (coalesce(merged, {step}) AS {step})
                FROM {last} LEFT JOIN {c}_a USING ({keys}, {step}))""",
        ]
        last = c
    template = "replace('/' || concat_ws('/', " + ", ".join(steps) + f"), '/{END}', '')"
    ctes += [
        f"named AS (SELECT host, shape, allow, block, {template} AS template FROM {last})",
        """judged AS (SELECT host, shape, (sum(allow) OVER w + 1.0) / (sum(allow) OVER w
            + sum(block) OVER w + 2.0) AS purity, template FROM named
            WINDOW w AS (PARTITION BY host, template))""",
    ]
    return f"""WITH {", ".join(ctes)}
        SELECT page_id, host, path, rule, template, coalesce(label,
            CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM found LEFT JOIN judged USING (host, shape)"""
