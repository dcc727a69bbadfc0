"""Registry entries for baskets, popularity, rules and recommendations."""

from __future__ import annotations

from ..operators import baskets as B
from ..sources.star import load_star
from .oracle_star import star


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


def _rules(sp, sf):
    s = _a(sp, sf)
    rules, _ = B.mine_rules(B.baskets(s.fact, s.products))
    return rules


def _recs(sp, sf, k=50):
    s = _a(sp, sf)
    return B.recommend_all(B.rank_rules(_rules(sp, sf)), B.popularity(s.fact, s.products, k), s.products, 5)


def _pair_rules(sp, sf, min_lift):
    s = _a(sp, sf)
    rules, _ = B.mine_rules(B.baskets(s.fact, s.products), min_lift=min_lift)
    return rules.where("size(antecedents) = 1 AND size(consequents) = 1").selectExpr(
        "antecedents[0] AS antecedent", "consequents[0] AS consequent", "support", "confidence", "lift")


SPARK = {
    "m23_baskets": lambda sp, sf: B.baskets(_a(sp, sf).fact, _a(sp, sf).products),
    "m24_popularity": lambda sp, sf: B.popularity(_a(sp, sf).fact, _a(sp, sf).products, 50),
    "m26_association_rules": _rules,
    "m24_popularity_top3": lambda sp, sf: B.popularity(_a(sp, sf).fact, _a(sp, sf).products, 3),
    # no least lift, as at 1 the test tables have no rule between single items
    "m26_pair_rules": lambda sp, sf: _pair_rules(sp, sf, 0.0),
    # with a popularity list of three, most subjects are not on it
    "m27_recommendations_top3": lambda sp, sf: _recs(sp, sf, 3),
    "m27_recommendations": _recs,
    "d9_recommendation_sources": lambda sp, sf: B.source_mix(_recs(sp, sf)),
}

RAW = {
    "m23_baskets": """
SELECT f.transaction_id, list_sort(list_distinct(list(p.subcategory))) AS items
FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id WHERE p.subcategory IS NOT NULL
GROUP BY f.transaction_id""",
    "m24_popularity": """
SELECT subcategory, n_transactions, ROW_NUMBER() OVER (ORDER BY n_transactions DESC, subcategory) AS pop_rank
FROM (SELECT p.subcategory, COUNT(DISTINCT f.transaction_id) AS n_transactions
      FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id WHERE p.subcategory IS NOT NULL
      GROUP BY p.subcategory) t ORDER BY n_transactions DESC, subcategory LIMIT 50""",
    # 1 -> 1 rules from pair counts at the first support level (0.5 %): FP-Growth keeps count >= ceil(s * N)
    "m26_pair_rules": """
WITH b AS (SELECT DISTINCT f.transaction_id, p.subcategory AS item
           FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id WHERE p.subcategory IS NOT NULL),
n AS (SELECT COUNT(DISTINCT transaction_id) AS n FROM b),
single AS (SELECT item, COUNT(*) AS c FROM b GROUP BY item),
pair AS (SELECT x.item AS a, y.item AS c2, COUNT(*) AS cnt FROM b x JOIN b y
         ON x.transaction_id = y.transaction_id AND x.item <> y.item GROUP BY 1, 2)
SELECT pair.a AS antecedent, pair.c2 AS consequent, pair.cnt / n.n AS support,
       pair.cnt / sa.c AS confidence, (pair.cnt / sa.c) / (sc.c / n.n) AS lift
FROM pair, n, single sa, single sc
WHERE sa.item = pair.a AND sc.item = pair.c2 AND pair.cnt >= CEIL(0.005 * n.n)
""",
}

# all itemsets are grown item by item in alphabetical order and counted by list containment
_RULES = """
WITH RECURSIVE b AS (SELECT f.transaction_id AS t, list_sort(list_distinct(list(p.subcategory))) AS items
           FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id WHERE p.subcategory IS NOT NULL GROUP BY 1),
n AS (SELECT COUNT(*) AS n FROM b),
it AS (SELECT DISTINCT UNNEST(items) AS i FROM b),
sets AS (SELECT [i] AS s, i AS last FROM it UNION ALL SELECT list_append(s, i), i FROM sets, it WHERE i > last),
fr AS (SELECT s, COUNT(*) AS c FROM sets JOIN b ON list_has_all(b.items, sets.s) GROUP BY s
       HAVING COUNT(*) >= CEIL(0.005 * (SELECT n FROM n))),
rules AS (SELECT a.s AS antecedents, c.s AS consequents, w.c / CAST(n.n AS DOUBLE) AS support, w.c / CAST(a.c AS DOUBLE) AS confidence,
                 (w.c / CAST(a.c AS DOUBLE)) / (c.c / CAST(n.n AS DOUBLE)) AS lift
          FROM fr w JOIN fr a ON len(a.s) < len(w.s) AND list_has_all(w.s, a.s)
               JOIN fr c ON c.s = list_filter(w.s, lambda x: NOT list_contains(a.s, x)), n
          WHERE (w.c / CAST(a.c AS DOUBLE)) / (c.c / CAST(n.n AS DOUBLE)) >= 1.0)"""
_RECS = _RULES + """,
rk AS (SELECT *, ROW_NUMBER() OVER (ORDER BY lift DESC, array_to_string(antecedents, '|'), array_to_string(consequents, '|')) AS r
       FROM rules),
subj AS (SELECT DISTINCT subcategory AS s FROM dim_products WHERE subcategory IS NOT NULL),
hit AS (SELECT s, consequents, confidence, lift, r FROM subj JOIN rk ON list_contains(antecedents, s)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY s ORDER BY r) <= 5),
t1 AS (SELECT s, rec, ROUND(confidence, 4) AS confidence, ROUND(lift, 4) AS lift, 'association_rules' AS source,
              ROW_NUMBER() OVER (PARTITION BY s ORDER BY r, pos) AS o
       FROM (SELECT s, r, confidence, lift, UNNEST(consequents) AS rec, UNNEST(range(len(consequents))) AS pos FROM hit) x
       WHERE rec <> s QUALIFY ROW_NUMBER() OVER (PARTITION BY s ORDER BY r, pos) <= 5),
pop AS (SELECT subcategory AS rec, ROW_NUMBER() OVER (ORDER BY COUNT(DISTINCT f.transaction_id) DESC, subcategory) AS pr
        FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id WHERE subcategory IS NOT NULL GROUP BY subcategory
        QUALIFY pr <= {k}),
t2 AS (SELECT s, rec, NULL AS confidence, NULL AS lift, 'popularity_fallback' AS source, 1000 + pr AS o
       FROM subj JOIN pop ON pop.rec <> subj.s AND pr <= 11 WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.s = subj.s AND t1.rec = pop.rec)),
u AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY s ORDER BY o) AS slot FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2) z)
"""
_REC_ROWS = "SELECT s AS subcategory, slot, rec AS recommendation, confidence, lift, source FROM u WHERE slot <= 5"


def _recursive(sql: str) -> str:
    """The star prefix begins the WITH list, so the keyword RECURSIVE moves to its front."""
    return star(sql.replace("WITH RECURSIVE", "WITH", 1)).replace("WITH", "WITH RECURSIVE", 1)


RAW["m24_popularity_top3"] = RAW["m24_popularity"].replace("LIMIT 50", "LIMIT 3")

ORACLE = {k: star(v) for k, v in RAW.items()}
ORACLE |= {
    "m26_association_rules": _recursive(_RULES + "\nSELECT * FROM rules"),
    "m27_recommendations": _recursive(_RECS.format(k=50) + _REC_ROWS),
    "m27_recommendations_top3": _recursive(_RECS.format(k=3) + _REC_ROWS),
    "d9_recommendation_sources": _recursive(_RECS.format(k=50) + "SELECT source, COUNT(*) AS n FROM u WHERE slot <= 5 GROUP BY source"),
}
