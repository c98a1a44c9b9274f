"""The same queries as plain SQL over the test tables, for checking results.

Written from the definitions, not from the DataFrame code: where an operator
takes another road (two-level numbering, distinct tails, rarest terms), the SQL
takes the direct one.
"""

from __future__ import annotations

import re

from shelfrank.schemas import CHANNELS

_WORD = r"[\p{L}\p{N}_]+(?:[''’.][\p{L}\p{N}_]+)*"

_FIELDS = list(CHANNELS.values())


def _channel(number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(CHANNELS))
    return f"CASE {number} {cases} END"


def _term(path: str) -> str:
    return (
        "regexp_replace(regexp_replace(regexp_replace(regexp_replace("
        rf"regexp_extract({path}, '([^\/]+)$', 1), '(\+)+', ' ', 'g'), 't ', 't', 'g'), "
        r"' s ?', ' ', 'g'), '\.axd', '', 'g')"
    )


def _search_page(path: str) -> str:
    return (
        rf"(regexp_matches({path}, 'google\+redesign') AND NOT "
        rf"regexp_matches({path}, '\.html|home'))"
    )


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_WORD}')"


def _hash(*parts: str) -> str:
    key = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"(CAST(concat('0x', substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0)"


def _ctr(part: str, whole: str) -> str:
    ratio = f"(CAST({part} AS DOUBLE) / {whole})"
    return f"coalesce(CASE WHEN {ratio} > 1 THEN 1.0 ELSE {ratio} END, 0.0)"


def _channel_group(channel: str) -> str:
    return f"coalesce(replace(lower({channel}), ' ', '_'), '')"


_WINDOW = "CAST(floor((day(e.ts) - 1) / 10) AS BIGINT)"

CTES: dict[str, str] = {}

CTES["event_hits"] = f"""
SELECT e.user_id AS fv, e.user_id * 10 + {_WINDOW} AS session_id,
       {_channel(f"(e.user_id + {_WINDOW}) % 8")} AS channel,
       CAST(e.ts AS DATE) AS session_date, e.event_id AS hit_pos, 0 AS product_pos,
       CASE e.event_type WHEN 'signup' THEN '/google+redesign/home'
                         WHEN 'error' THEN '/google+redesign/err.html'
            ELSE concat('/google+redesign/shop/', split_part(p.p_name, ' ', 2),
                        CASE WHEN e.event_id % 2 = 0 THEN '.axd' ELSE '' END) END AS pagepath,
       CASE WHEN e.event_type = 'purchase' THEN '6' ELSE '0' END AS action_type,
       CASE WHEN e.event_id % 97 = 0 THEN '(not set)' ELSE CAST(p.p_partkey AS VARCHAR) END AS sku,
       p.p_name AS name, concat(p.p_type, '/', p.p_brand) AS category,
       CAST(round((p.p_retailprice - 900) * 10 * 1000000) AS BIGINT) AS price_micros,
       CASE WHEN e.event_type = 'click' THEN true END AS is_click,
       CASE WHEN e.event_type = 'view' THEN true END AS is_impression
FROM events e JOIN part p
  ON p.p_partkey = CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT)"""

CTES["order_hits"] = f"""
SELECT o_custkey AS fv, o_orderkey AS session_id, {_channel("o_custkey % 8")} AS channel,
       CAST(o_orderdate AS DATE) AS session_date, l_linenumber AS hit_pos,
       l_partkey AS product_pos,
       concat('/google+redesign/shop/', replace(lower(substr(o_orderpriority, 3)), ' ', '+'))
         AS pagepath,
       CASE WHEN l_returnflag = 'R' THEN '6' ELSE '0' END AS action_type,
       CAST(l_partkey AS VARCHAR) AS sku,
       CAST(round(l_extendedprice / l_quantity * 1000000) AS BIGINT) AS price_micros,
       CASE WHEN l_returnflag <> 'N' THEN true END AS is_click, true AS is_impression
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["visits"] = f"""
SELECT e.event_id AS session_id, e.user_id AS fv, e.event_type, CAST(e.ts AS DATE) AS session_date,
       CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS k, e.event_id % 4 AS listed,
       CASE e.event_type WHEN 'signup' THEN '/google+redesign/home'
                         WHEN 'error' THEN '/google+redesign/err.html'
            ELSE concat('/google+redesign/shop/', e.event_type, '+',
                        CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) % 10) END AS pagepath
FROM events e"""

CTES["visit_products"] = """
SELECT v.*, i.i AS product_pos, v.k + i.i AS number,
       CASE WHEN (v.k + i.i) % 10 = 9 THEN '(not set)'
            ELSE CAST(v.k + i.i AS VARCHAR) END AS sku,
       CASE WHEN v.event_type = 'click' AND i.i = 0 THEN 1 ELSE 0 END AS click
FROM visits v JOIN (SELECT unnest([0, 1, 2]) AS i) i ON i.i < v.listed"""


def _numbered(hits: str) -> str:
    return f"""
SELECT session_id, fv, {_term("pagepath")} AS query, sku AS doc,
       CASE WHEN is_click THEN 1 ELSE 0 END AS click,
       row_number() OVER (PARTITION BY session_id ORDER BY hit_pos, product_pos) AS position
FROM {hits} WHERE sku <> '(not set)' AND {_search_page("pagepath")}"""


def _docs(hits: str, shown: str) -> str:
    return f"""
SELECT r.session_id, r.fv, r.query, r.doc, r.position,
       CASE WHEN b.doc IS NULL THEN 0 ELSE 1 END AS purchase,
       CASE WHEN b.doc IS NULL THEN r.click ELSE 1 END AS click
FROM (SELECT session_id, query, doc, max(fv) AS fv, max(click) AS click,
             min(position) AS position
      FROM {shown} GROUP BY session_id, query, doc) r
LEFT JOIN (SELECT DISTINCT session_id, sku AS doc FROM {hits} WHERE action_type = '6') b
  ON b.session_id = r.session_id AND b.doc = r.doc"""


def _lists(docs: str, rate: float) -> str:
    sampled = (
        "true" if rate >= 1 else f"(click = 1 OR {_hash('session_id', 'query', 'doc')} < {rate})"
    )
    return f"""
SELECT *, max(CASE WHEN click = 1 THEN list_pos ELSE 0 END)
            OVER (PARTITION BY session_id, query) AS last_click
FROM (SELECT session_id, query, fv, doc, click, purchase,
             row_number() OVER (PARTITION BY session_id, query ORDER BY position) AS list_pos,
             count(*) OVER (PARTITION BY session_id, query) AS n_docs
      FROM (SELECT *, max(CASE WHEN purchase = 1 THEN position END) OVER w AS last_position,
                   max(click) OVER w AS any_click, sum(purchase) OVER w AS purchases
            FROM {docs} WINDOW w AS (PARTITION BY session_id, query)) t
      WHERE any_click = 1 AND purchases <= 1
        AND (last_position IS NULL OR position <= last_position) AND {sampled}) k
WHERE n_docs BETWEEN 3 AND 500"""


def _visitors(hits: str) -> str:
    return f"""
SELECT fv, coalesce(max(CASE WHEN first_one = 1 THEN channel_group END), '') AS channel_group,
       round(coalesce(avg(ticket), 0.0), 9) AS raw_ticket,
       CAST(round(round(coalesce(avg(ticket), 0.0), 9)) AS BIGINT) AS avg_ticket
FROM (SELECT fv, session_id, avg(price_micros / 1e6) AS ticket,
             {_channel_group("max(channel)")} AS channel_group,
             row_number() OVER (PARTITION BY fv ORDER BY session_id) AS first_one
      FROM {hits} GROUP BY fv, session_id) s
GROUP BY fv"""


def _sets(lists: str, visitors: str) -> str:
    return f"""
SELECT l.query AS search_term, coalesce(v.channel_group, '') AS channel_group,
       coalesce(v.avg_ticket, 0) AS customer_avg_ticket, l.*
FROM {lists} l LEFT JOIN {visitors} v ON v.fv = l.fv"""


def _sdbn(lists: str, keys: str) -> str:
    return f"""
SELECT {keys}, doc, coalesce(clicks / nullif(shows, 0), 0.0) AS alpha,
       coalesce(last_clicks / nullif(clicks, 0), 0.0) AS sigma,
       coalesce(clicks / nullif(shows, 0), 0.0) * coalesce(last_clicks / nullif(clicks, 0), 0.0)
         AS judgment
FROM (SELECT {keys}, doc, CAST(sum(click) AS DOUBLE) AS clicks,
             CAST(sum(CASE WHEN list_pos <= last_click THEN 1 ELSE 0 END) AS DOUBLE) AS shows,
             CAST(sum(CASE WHEN list_pos = last_click THEN 1 ELSE 0 END) AS DOUBLE) AS last_clicks
      FROM {lists} GROUP BY {keys}, doc) c"""


def _graded(judgments: str, keys: str) -> str:
    return f"""
SELECT {keys}, doc, alpha, sigma, judgment,
       CASE WHEN judgment <= p[1] + 1e-12 THEN 0 WHEN judgment <= p[2] + 1e-12 THEN 1
            WHEN judgment <= p[3] + 1e-12 THEN 2 WHEN judgment <= p[4] + 1e-12 THEN 3
            ELSE 4 END AS grade
FROM {judgments} JOIN (
  SELECT {keys}, quantile_cont(judgment, [0.2, 0.4, 0.6, 0.8, 1.0]) AS p
  FROM {judgments} GROUP BY {keys} HAVING max(judgment) > min(judgment)) q USING ({keys})"""


for _name in ("event", "order"):
    CTES[f"{_name}_shown"] = _numbered(f"{_name}_hits")
    CTES[f"{_name}_docs"] = _docs(f"{_name}_hits", f"{_name}_shown")
    CTES[f"{_name}_lists"] = _lists(f"{_name}_docs", 1.0)
    CTES[f"{_name}_visitors"] = _visitors(f"{_name}_hits")
    CTES[f"{_name}_sets"] = _sets(f"{_name}_lists", f"{_name}_visitors")
    CTES[f"{_name}_sdbn"] = _sdbn(f"{_name}_lists", "query")
    CTES[f"{_name}_graded"] = _graded(f"{_name}_sdbn", "query")
CTES["event_sampled"] = _lists("event_docs", 0.01)
_CONTEXT = "search_term, channel_group, customer_avg_ticket"
CTES["context_sdbn"] = _sdbn("event_sets", _CONTEXT)
CTES["context_graded"] = _graded("context_sdbn", _CONTEXT)

CTES["validation"] = f"""
SELECT h.set_name, d.query AS search_term, {_channel_group("h.channel")} AS channel_group,
       coalesce(v.avg_ticket, 0) AS customer_avg_ticket, coalesce(v.raw_ticket, 0.0) AS raw_ticket,
       d.session_id, d.doc AS sku
FROM event_docs d
JOIN (SELECT session_id, max(channel) AS channel,
             CASE WHEN day(max(session_date)) <= 10 THEN 'train'
                  WHEN day(max(session_date)) <= 20 THEN 'validation' ELSE 'test' END AS set_name
      FROM event_hits GROUP BY session_id) h ON h.session_id = d.session_id
LEFT JOIN {{visitors}} v ON v.fv = d.fv{{on_set}}
WHERE d.purchase = 1"""
CTES["validation_all"] = CTES["validation"].format(visitors="event_visitors", on_set="")
# the windows are whole sessions here, so a visitor's sessions split by window
CTES["set_visitors"] = f"""
SELECT set_name, fv, round(coalesce(avg(ticket), 0.0), 9) AS raw_ticket,
       CAST(round(round(coalesce(avg(ticket), 0.0), 9)) AS BIGINT) AS avg_ticket
FROM (SELECT fv, session_id, avg(price_micros / 1e6) AS ticket,
             CASE WHEN day(max(session_date)) <= 10 THEN 'train'
                  WHEN day(max(session_date)) <= 20 THEN 'validation' ELSE 'test' END AS set_name
      FROM event_hits GROUP BY fv, session_id) s
GROUP BY set_name, fv"""
CTES["validation_sets"] = CTES.pop("validation").format(
    visitors="set_visitors", on_set=" AND v.set_name = h.set_name"
)

CTES["per_session"] = """
SELECT session_id, channel, sku, category, name,
       CAST(sum(CASE WHEN is_impression THEN 1 WHEN NOT is_impression THEN 0 END) AS BIGINT)
         AS impressions,
       CAST(sum(CASE WHEN is_click THEN 1 WHEN NOT is_click THEN 0 END) AS BIGINT) AS clicks,
       avg(price_micros / 1e6) AS price
FROM event_hits GROUP BY session_id, channel, sku, category, name"""

_OWN = _ctr("sum(clicks)", "coalesce(nullif(sum(impressions), 0), 1)")
_OWN_COLUMNS = ", ".join(
    f"CASE WHEN channel = '{label}' THEN {_OWN} ELSE 0.0 END AS ctr_{field}"
    for label, field in CHANNELS.items()
)
CTES["sku_totals"] = """
SELECT sku, avg(price) AS price, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks
FROM per_session GROUP BY sku HAVING sum(impressions) > 0"""
# equal (impressions, clicks) of a product in a channel count once
CTES["channel_rates"] = f"""
SELECT sku, channel, name, category, {_OWN_COLUMNS}
FROM (SELECT sku, channel, name, replace(category, '/', ' ') AS category, impressions, clicks
      FROM per_session GROUP BY ALL) once
GROUP BY sku, channel, name, category"""
CTES["catalog_rows"] = f"""
SELECT r.sku, r.channel, r.name, r.category, coalesce(t.price, 0) AS price, t.impressions,
       t.clicks, {_ctr("t.clicks", "t.impressions")} AS ctr, {", ".join(f"r.ctr_{f}" for f in _FIELDS)}
FROM channel_rates r JOIN sku_totals t ON t.sku = r.sku"""

CTES["catalog_last"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku
         ORDER BY channel DESC NULLS LAST, name DESC, category DESC) AS place FROM catalog_rows) r
WHERE place = 1"""

CTES["catalog"] = f"""
SELECT l.sku, l.name, l.category, l.price, l.impressions, l.clicks, l.ctr,
       {", ".join(f"m.ctr_{f}" for f in _FIELDS)}
FROM catalog_last l JOIN (
  SELECT sku, {", ".join(f"max(ctr_{f}) AS ctr_{f}" for f in _FIELDS)}
  FROM catalog_rows GROUP BY sku) m ON m.sku = l.sku"""

CTES["words"] = f"""
SELECT sku, 'name' AS field, unnest({_tokens("name")}) AS term FROM catalog
UNION ALL
SELECT sku, 'category' AS field, unnest({_tokens("category")}) AS term FROM catalog"""
CTES["lengths"] = "SELECT sku, field, count(*) AS len FROM words GROUP BY sku, field"
CTES["fields"] = "SELECT field, count(*) AS n, avg(len) AS average FROM lengths GROUP BY field"
CTES["frequencies"] = (
    "SELECT field, term, count(DISTINCT sku) AS df FROM words GROUP BY field, term"
)
CTES["weights"] = """
SELECT w.sku, w.field, w.term,
       w.tf * 2.2 / (w.tf + 1.2 * (0.25 + 0.75 * l.len / f.average)) AS part,
       ln(1 + (f.n - q.df + 0.5) / (q.df + 0.5)) AS own_idf
FROM (SELECT sku, field, term, count(*) AS tf FROM words GROUP BY sku, field, term) w
JOIN lengths l ON l.sku = w.sku AND l.field = w.field
JOIN fields f ON f.field = w.field
JOIN frequencies q ON q.field = w.field AND q.term = w.term"""


def _query_words(queries: str) -> str:
    return f"""
SELECT search_term, term, count(*) AS times
FROM (SELECT search_term, unnest({_tokens("search_term")}) AS term
      FROM (SELECT DISTINCT search_term FROM {queries}) d) t
GROUP BY search_term, term"""


CTES["judged_words"] = _query_words("(SELECT query AS search_term FROM event_graded)")
CTES["judged_scores"] = """
SELECT q.search_term, w.sku, sum(CASE WHEN w.field = 'name' THEN q.times * own_idf * part END)
         AS bm25_name,
       sum(CASE WHEN w.field = 'category' THEN q.times * own_idf * part END) AS bm25_category
FROM judged_words q JOIN weights w ON w.term = q.term GROUP BY q.search_term, w.sku"""


def _first_pass(queries: str, words: str) -> str:
    return f"""
SELECT search_term, sku, round(score, 9) AS score,
       row_number() OVER (PARTITION BY search_term ORDER BY round(score, 9) DESC, sku) - 1 AS pos
FROM (
  SELECT m.search_term, m.sku, greatest(m.score, m.key_score) + coalesce(c.ctr, 0) * 10 AS score
  FROM (
    SELECT search_term, sku, max(score) AS score, max(key_score) AS key_score FROM (
      SELECT q.search_term, b.sku,
             sum(q.times * ln(1 + (t.n - a.df + 0.5) / (a.df + 0.5)) * b.part) AS score,
             0.0 AS key_score
      FROM {words} q
      JOIN (SELECT sku, term, max(part) AS part FROM weights GROUP BY sku, term) b
        ON b.term = q.term
      JOIN (SELECT term, max(df) AS df FROM frequencies GROUP BY term) a ON a.term = q.term
      CROSS JOIN (SELECT count(*) AS n FROM catalog) t
      JOIN (SELECT search_term, count(*) AS n_terms FROM {words} GROUP BY search_term) s
        ON s.search_term = q.search_term
      GROUP BY q.search_term, b.sku, s.n_terms HAVING count(*) = s.n_terms
      UNION ALL
      SELECT q.search_term, c.sku, 0.0 AS score, ln(1 + (t.n - 0.5) / 1.5) AS key_score
      FROM (SELECT DISTINCT search_term FROM {queries}) q JOIN catalog c ON c.sku = q.search_term
      CROSS JOIN (SELECT count(*) AS n FROM catalog) t) u
    GROUP BY search_term, sku) m
  JOIN catalog c ON c.sku = m.sku) f"""


CTES["searches"] = """
SELECT DISTINCT split_part(p_name, ' ', 2) AS search_term FROM part
UNION SELECT DISTINCT p_name FROM part UNION SELECT CAST(p_partkey AS VARCHAR) FROM part"""
CTES["search_words"] = _query_words("searches")
CTES["first_pass"] = _first_pass("searches", "search_words")
CTES["context_words"] = _query_words("validation_sets")
CTES["context_pass"] = _first_pass("validation_sets", "context_words")


def _features(rows: str) -> str:
    own = " ".join(f"WHEN '{f}' THEN c.ctr_{f}" for f in _FIELDS)
    return f"""
SELECT r.*, ln(1 + abs(c.price - r.customer_avg_ticket)) AS f1,
       coalesce(s.bm25_category, 0.0) AS f2,
       coalesce(CASE r.channel_group {own} ELSE 0.0 END, 0.0) * 10 AS f3,
       coalesce(s.bm25_name, 0.0) AS f4
FROM {rows} r JOIN catalog c ON c.sku = r.sku
LEFT JOIN {{scores}} s ON s.search_term = r.search_term AND s.sku = r.sku"""


CTES["judged"] = """
SELECT search_term, channel_group, customer_avg_ticket, doc AS sku, grade FROM context_graded"""
CTES["context_judged_words"] = _query_words("judged")
CTES["context_judged_scores"] = CTES["judged_scores"].replace(
    "judged_words", "context_judged_words"
)
CTES["features"] = _features("judged").format(scores="context_judged_scores")
CTES["numbered_features"] = f"""
SELECT f.*, i.qid FROM features f JOIN (
  SELECT {_CONTEXT}, row_number() OVER (ORDER BY {_CONTEXT}) - 1 AS qid
  FROM features GROUP BY {_CONTEXT} HAVING count(*) >= 2) i USING ({_CONTEXT})"""
CTES["normalised"] = f"""
SELECT {_CONTEXT}, sku, grade, qid, {", ".join(
    f"CASE WHEN sum(abs(f{i})) OVER w > 0 THEN f{i} / sum(abs(f{i})) OVER w ELSE 0.0 END AS f{i}"
    for i in (1, 2, 3, 4))}
FROM numbered_features WINDOW w AS (PARTITION BY qid)"""

# the two trees of plans.queries.SMALL_MODEL
_SMALL_MODEL = """
(0.1 * (CASE WHEN f1 <= 2.55 THEN CASE WHEN f4 <= 1.05 THEN -0.5 ELSE 1.5 END
             ELSE CASE WHEN f3 <= 4.05 THEN -1.25 ELSE 0.75 END END)
 + 0.2 * (CASE WHEN f3 <= 6.15 THEN -0.3 ELSE 0.9 END))"""

CTES["listed"] = f"""
SELECT DISTINCT v.set_name, v.search_term, v.channel_group, v.customer_avg_ticket, p.sku,
       p.score, p.pos
FROM validation_sets v JOIN context_pass p ON p.search_term = v.search_term WHERE p.pos < 1000"""
CTES["context_scores"] = CTES["judged_scores"].replace("judged_words", "context_words")
CTES["listed_features"] = _features("listed").format(scores="context_scores")
CTES["rescored"] = f"""
SELECT set_name, {_CONTEXT}, sku, final,
       row_number() OVER (PARTITION BY set_name, {_CONTEXT}
                          ORDER BY inside DESC, final DESC, sku) - 1 AS pos
FROM (SELECT *, CASE WHEN pos < 50 THEN 1 ELSE 0 END AS inside,
             round(CASE WHEN pos < 50 THEN 0.1 * score + 20 * {_SMALL_MODEL} ELSE score END, 9)
               AS final
      FROM listed_features) x"""


def _rank(retrieved: str) -> str:
    return f"""
SELECT s.set_name, round(coalesce(r.rank, 0.5), 6) AS rank
FROM (SELECT DISTINCT set_name FROM validation_sets) s LEFT JOIN (
  SELECT set_name, sum(pos / (n - 1)) / count(*) AS rank
  FROM (SELECT set_name, {_CONTEXT}, sku, pos,
               count(*) OVER (PARTITION BY set_name, {_CONTEXT}) AS n FROM {retrieved}) l
  JOIN (SELECT DISTINCT set_name, {_CONTEXT}, raw_ticket, sku FROM validation_sets) b
    USING (set_name, {_CONTEXT}, sku)
  WHERE n >= 2 GROUP BY set_name) r ON r.set_name = s.set_name"""


def _query(final: str) -> str:
    """``final`` after the CTEs it names, each after those it needs itself."""
    ordered: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                add(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    add(final)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + final


def _big(*names: str) -> str:
    return ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in names)


def _round(*names: str) -> str:
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


def _one_step() -> str:
    """One EM step from alpha = sigma = 0.5, gamma = 0.9, in closed form.

    With equal parameters the no-click chance of k remaining places is
    1/11 + 10/11 * 0.45^k.
    """
    quiet = "(1.0 / 11 + 10.0 / 11 * pow(0.45, {}))"
    return f"""
WITH rows AS (
  SELECT query, doc, session_id, click, purchase, list_pos, last_click, n_docs,
         n_docs - last_click AS tail,
         max(CASE WHEN list_pos = last_click THEN purchase ELSE 0 END)
           OVER (PARTITION BY session_id, query) AS bought
  FROM event_lists),
solved AS (
  SELECT *, CASE WHEN tail = 0 THEN 1.0
                 ELSE 0.5 + 0.5 * (0.1 + 0.9 * {quiet.format("tail")}) END AS z
  FROM rows),
probs AS (
  SELECT *, CASE WHEN list_pos > last_click AND bought = 0
                 THEN 0.45 / z * pow(0.45, list_pos - last_click - 1)
                      * {quiet.format("n_docs - list_pos + 1")} ELSE 0.0 END AS seen,
         CASE WHEN bought = 1 THEN 1.0 ELSE 0.5 / z END AS satisfied
  FROM solved),
gamma AS (
  SELECT sum(CASE WHEN list_pos < last_click THEN 1.0 ELSE seen END)
         / sum(CASE WHEN list_pos < last_click THEN 1.0
                    WHEN list_pos = last_click AND tail > 0 THEN 1 - satisfied
                    WHEN list_pos > last_click AND list_pos < n_docs THEN seen
                    ELSE 0.0 END) AS gamma
  FROM probs)
SELECT query, doc, round(alpha, 6) AS alpha, round(sigma, 6) AS sigma,
       round(gamma, 6) AS gamma, round(alpha * sigma, 6) AS judgment
FROM (SELECT query, doc,
             sum(CASE WHEN list_pos <= last_click THEN click ELSE 0.5 * (1 - seen) END) / count(*)
               AS alpha,
             coalesce(sum(CASE WHEN list_pos = last_click THEN satisfied ELSE 0.0 END)
                      / nullif(sum(click), 0), 0.0) AS sigma
      FROM probs GROUP BY query, doc) p CROSS JOIN gamma"""


def _em(rounds: int, lists: str) -> str:
    """The EM rounds one after the other; a list's tail is walked with list_reduce."""
    parts = [
        f"""em_rows AS MATERIALIZED (
  SELECT query, doc, session_id, click, purchase, list_pos, last_click, n_docs,
         n_docs - last_click AS tail, max(CASE WHEN list_pos = last_click THEN purchase ELSE 0 END)
           OVER (PARTITION BY session_id, query) AS bought
  FROM {lists})""",
        """em0 AS MATERIALIZED (
  SELECT DISTINCT query, doc, CAST(0.5 AS DOUBLE) AS alpha, CAST(0.5 AS DOUBLE) AS sigma,
         CAST(0.9 AS DOUBLE) AS gamma FROM em_rows)""",
    ]
    for number in range(1, rounds + 1):
        parts.append(
            f"""lists{number} AS MATERIALIZED (
  SELECT r.session_id, r.query, any_value(p.gamma) AS g,
         coalesce(list(p.alpha ORDER BY list_pos) FILTER (list_pos > last_click), []) AS alphas,
         max(CASE WHEN list_pos = last_click THEN p.sigma END) AS s
  FROM em_rows r JOIN em{number - 1} p ON p.query = r.query AND p.doc = r.doc
  GROUP BY r.session_id, r.query),
probs{number} AS MATERIALIZED (
  SELECT r.*, p.alpha AS old_alpha,
         CASE WHEN l.s IS NULL THEN quiet_first WHEN tail = 0 THEN 1.0
              ELSE l.s + (1 - l.s) * (1 - l.g + l.g * quiet_first) END AS z,
         CASE WHEN list_pos > last_click AND bought = 0 THEN
           CASE WHEN l.s IS NULL THEN 1.0 ELSE (1 - l.s) * l.g END
           * list_reduce([1.0::DOUBLE] || l.alphas[1:list_pos - last_click - 1],
                         lambda acc, a: acc * l.g * (1 - a))
           * list_reduce([1.0::DOUBLE] || list_reverse(l.alphas[list_pos - last_click:]),
                         lambda acc, a: (1 - a) * (1 - l.g + l.g * acc))
           ELSE 0.0 END AS reached, l.s
  FROM em_rows r
  JOIN (SELECT *, list_reduce([1.0::DOUBLE] || list_reverse(alphas),
                              lambda acc, a: (1 - a) * (1 - g + g * acc)) AS quiet_first
        FROM lists{number}) l ON l.session_id = r.session_id AND l.query = r.query
  JOIN em{number - 1} p ON p.query = r.query AND p.doc = r.doc),
seen{number} AS MATERIALIZED (
  SELECT *, reached / z AS seen, CASE WHEN bought = 1 THEN 1.0 ELSE s / z END AS satisfied
  FROM probs{number}),
em{number} AS MATERIALIZED (
  SELECT query, doc,
         sum(CASE WHEN list_pos <= last_click THEN click ELSE old_alpha * (1 - seen) END)
           / count(*) AS alpha,
         coalesce(sum(CASE WHEN list_pos = last_click THEN satisfied ELSE 0.0 END)
                  / nullif(sum(click), 0), 0.0) AS sigma,
         (SELECT sum(CASE WHEN list_pos < last_click THEN 1.0
                          WHEN list_pos = 1 THEN 0.0 ELSE seen END)
                 / sum(CASE WHEN list_pos < last_click THEN 1.0
                            WHEN list_pos = last_click AND tail > 0 THEN 1 - satisfied
                            WHEN list_pos > last_click AND list_pos < n_docs THEN seen
                            ELSE 0.0 END) FROM seen{number}) AS gamma
  FROM seen{number} GROUP BY query, doc)"""
        )
    return (
        ",\n".join(parts)
        + f"""
SELECT query, doc, round(alpha, 6) AS alpha, round(sigma, 6) AS sigma,
       round(gamma, 6) AS gamma, round(alpha * sigma, 6) AS judgment FROM em{rounds}"""
    )


def _after(name: str, text: str) -> str:
    """Prefix CTEs of a query's own with those of a named one."""
    return _query(f"SELECT 1 FROM {name}").rsplit("\nSELECT 1", 1)[0] + ",\n" + (
        text.strip().removeprefix("WITH ")
    )


# every pair with a place among the first ten: ERR before and after its swap
_GRADIENTS = """
WITH placed AS MATERIALIZED (
  SELECT qid, sku, (pow(2, grade) - 1) / 16 AS gain, round(f1, 6) AS score,
         row_number() OVER (PARTITION BY qid ORDER BY round(f1, 6) DESC, sku) AS place
  FROM numbered_features),
pairs AS (
  SELECT a.qid, a.place AS first_place, b.place AS second_place, a.sku AS first_sku,
         b.sku AS second_sku, a.gain AS first_gain, b.gain AS second_gain,
         a.score AS first_score, b.score AS second_score
  FROM placed a JOIN placed b ON b.qid = a.qid AND b.place > a.place
  WHERE a.place <= 10 AND a.gain <> b.gain),
swapped AS (
  SELECT p.qid, p.first_place, p.second_place, r.place,
         CASE r.place WHEN p.first_place THEN p.second_gain WHEN p.second_place THEN p.first_gain
                      ELSE r.gain END AS gain
  FROM pairs p JOIN placed r ON r.qid = p.qid AND r.place <= 10),
after AS (
  SELECT qid, first_place, second_place, sum(gain * passed / place) AS err
  FROM (SELECT *, exp(coalesce(sum(ln(1 - gain)) OVER (
                 PARTITION BY qid, first_place, second_place ORDER BY place
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS passed FROM swapped) s
  GROUP BY qid, first_place, second_place),
base AS (
  SELECT qid, sum(gain * passed / place) AS err
  FROM (SELECT *, exp(coalesce(sum(ln(1 - gain)) OVER (PARTITION BY qid ORDER BY place
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS passed
        FROM placed WHERE place <= 10) s GROUP BY qid),
weighed AS (
  SELECT p.*, abs(a.err - b.err) AS change,
         1 / (1 + exp(CASE WHEN first_gain > second_gain THEN first_score - second_score
                           ELSE second_score - first_score END)) AS rho,
         CASE WHEN first_gain > second_gain THEN 1 ELSE -1 END AS sign
  FROM pairs p JOIN after a USING (qid, first_place, second_place) JOIN base b ON b.qid = p.qid),
sides AS (
  SELECT qid, first_sku AS sku, sign * change * rho AS lam, change * rho * (1 - rho) AS w
  FROM weighed
  UNION ALL SELECT qid, second_sku, -sign * change * rho, change * rho * (1 - rho) FROM weighed)
SELECT CAST(p.qid AS BIGINT) AS qid, p.sku AS doc, round(round(coalesce(sum(s.lam), 0.0), 9), 6) AS lam,
       round(round(coalesce(sum(s.w), 0.0), 9), 6) AS w
FROM placed p LEFT JOIN sides s ON s.qid = p.qid AND s.sku = p.sku GROUP BY p.qid, p.sku"""


# the best split of all documents by squared gradient sums, and a Newton step in each leaf
_FIRST_TREE = (
    _GRADIENTS.replace("round(f1, 6)", "0.0").split("\nSELECT CAST(p.qid")[0]
    + """,
steps AS MATERIALIZED (
  SELECT f.qid, f.sku, round(f.f1, 6) AS f1, round(f.f2, 6) AS f2, round(f.f3, 6) AS f3,
         round(f.f4, 6) AS f4, coalesce(g.lam, 0.0) AS lam, coalesce(g.w, 0.0) AS w
  FROM numbered_features f
  LEFT JOIN (SELECT qid, sku, sum(lam) AS lam, sum(w) AS w FROM sides GROUP BY qid, sku) g
    ON g.qid = f.qid AND g.sku = f.sku),
cells AS (SELECT qid, sku, lam, feature, x FROM steps UNPIVOT (x FOR feature IN (f1, f2, f3, f4))),
sums AS (
  SELECT DISTINCT feature, x,
         sum(lam) OVER (PARTITION BY feature ORDER BY x RANGE UNBOUNDED PRECEDING) AS low,
         count(*) OVER (PARTITION BY feature ORDER BY x RANGE UNBOUNDED PRECEDING) AS n_low,
         sum(lam) OVER (PARTITION BY feature) AS total, count(*) OVER (PARTITION BY feature) AS n
  FROM cells),
split AS (
  SELECT feature, x FROM sums WHERE n_low < n
  ORDER BY round(low * low / n_low + (total - low) * (total - low) / (n - n_low), 9) DESC, feature, x
  LIMIT 1),
sides_of AS (
  SELECT s.*, c.x <= split.x AS goes_left FROM steps s JOIN cells c ON c.qid = s.qid AND c.sku = s.sku
  JOIN split ON split.feature = c.feature)
SELECT CAST(qid AS BIGINT) AS qid, sku AS doc,
       round(0.1 * coalesce(sum(lam) OVER side / nullif(sum(w) OVER side, 0), 0.0), 6) AS score
FROM sides_of WINDOW side AS (PARTITION BY goes_left)"""
)


# rows of documents of some kinds lack values or come twice; copies are told apart by a suffix
_ODD_ROWS = """odd_features AS (
  SELECT qid, grade, sku || '#' || c.copy AS sku,
         CASE kind WHEN 0 THEN 0.0 ELSE f1 END AS f1, CASE kind WHEN 0 THEN 0.0 ELSE f2 END AS f2,
         CASE WHEN kind IN (0, 1) THEN 0.0 ELSE f3 END AS f3,
         CASE WHEN kind IN (0, 1, 2) THEN 0.0 ELSE f4 END AS f4
  FROM (SELECT *, CAST(sku AS BIGINT) % 5 AS kind FROM numbered_features) f
  JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR kind = 3)"""
_MISSING_TREE = (
    "WITH " + _ODD_ROWS + ",\n"
    + _FIRST_TREE.strip().removeprefix("WITH ").replace("numbered_features", "odd_features")
    .replace("sku AS doc", "split_part(sku, '#', 1) AS doc")
)


def _point_tree(rate: str) -> str:
    """The first split on the grades themselves; a side's score is ``rate`` times its mean."""
    tail = _FIRST_TREE[_FIRST_TREE.index("cells AS (") :].replace("round(0.1 *", f"round({rate} *")
    return (
        """WITH steps AS MATERIALIZED (
  SELECT qid, sku, round(f1, 6) AS f1, round(f2, 6) AS f2, round(f3, 6) AS f3, round(f4, 6) AS f4,
         CAST(grade AS DOUBLE) AS lam, 1.0::DOUBLE AS w FROM numbered_features),
"""
        + tail
    )


# one weight of four equal ones moves: ERR between all places where two lines of a list cross
_LINE_SEARCH = """
WITH points AS MATERIALIZED (
  SELECT qid, sku, (pow(2, grade) - 1) / 16 AS gain, round(f1, 6) AS f1, round(f2, 6) AS f2,
         round(f3, 6) AS f3, round(f4, 6) AS f4 FROM numbered_features),
moves AS MATERIALIZED (
  SELECT c.coordinate, qid, sku, gain, 0.25 * (f1 + f2 + f3 + f4) AS at,
         CASE c.coordinate WHEN 0 THEN f1 WHEN 1 THEN f2 WHEN 2 THEN f3 ELSE f4 END AS slope
  FROM points, (VALUES (0), (1), (2), (3)) c(coordinate)),
places AS MATERIALIZED (
  SELECT DISTINCT a.coordinate, a.qid, (b.at - a.at) / (a.slope - b.slope) AS t
  FROM moves a JOIN moves b ON b.coordinate = a.coordinate AND b.qid = a.qid AND b.slope < a.slope
  WHERE abs((b.at - a.at) / (a.slope - b.slope)) < 4
  UNION SELECT DISTINCT coordinate, qid, -4.0 FROM moves),
stretches AS MATERIALIZED (
  SELECT coordinate, qid, t, coalesce(lead(t) OVER (PARTITION BY coordinate, qid ORDER BY t), 4.0) AS until
  FROM places),
ranked AS (
  SELECT s.coordinate, s.qid, s.t, m.gain, row_number() OVER (
           PARTITION BY s.coordinate, s.qid, s.t
           ORDER BY m.at + (s.t + s.until) / 2 * m.slope DESC, m.sku) AS place
  FROM stretches s JOIN moves m ON m.coordinate = s.coordinate AND m.qid = s.qid),
list_err AS (
  SELECT coordinate, qid, t, sum(gain * passed / place) AS err FROM (
    SELECT *, exp(coalesce(sum(ln(1 - gain)) OVER (PARTITION BY coordinate, qid, t ORDER BY place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS passed
    FROM ranked WHERE place <= 10) p GROUP BY coordinate, qid, t),
changes AS (
  SELECT coordinate, t, sum(change) AS change FROM (
    SELECT coordinate, t, err - coalesce(lag(err) OVER (PARTITION BY coordinate, qid ORDER BY t), 0) AS change
    FROM list_err) e GROUP BY coordinate, t),
running AS (
  SELECT coordinate, sum(change) OVER (PARTITION BY coordinate ORDER BY t) AS value FROM changes)
SELECT CAST(coordinate AS BIGINT) AS coordinate,
       round(max(value) / (SELECT count(DISTINCT qid) FROM points), 6) AS err
FROM running GROUP BY coordinate"""


def _list_columns() -> str:
    return "session_id, query, doc, " + _big("click", "purchase", "list_pos", "last_click")


def _rates() -> tuple[str, ...]:
    return tuple(f"ctr_{field}" for field in _FIELDS)


def oracles() -> dict[str, str]:
    out = {}
    out["search_hits"] = _query(
        f"SELECT session_id, query, doc, {_big('click', 'position')} FROM event_shown"
    )
    out["unnest_hits"] = _query(
        """SELECT v.session_id, CAST(0 AS BIGINT) AS hit_pos, CAST(p.product_pos AS BIGINT)
                  AS product_pos, p.sku FROM visits v
           LEFT JOIN visit_products p ON p.session_id = v.session_id
           UNION ALL SELECT session_id, 1, 0, CASE WHEN k % 10 = 9 THEN '(not set)'
                  ELSE CAST(k AS VARCHAR) END FROM visits"""
    )
    out["unnest_products"] = _query(
        """SELECT sku, CAST(count(*) AS BIGINT) AS n, round(avg(price), 6) AS price FROM (
             SELECT sku, CAST(number AS DOUBLE) AS price FROM visit_products
             UNION ALL SELECT CASE WHEN k % 10 = 9 THEN '(not set)' ELSE CAST(k AS VARCHAR) END,
                              CAST(k AS DOUBLE) FROM visits) u GROUP BY sku"""
    )
    out["nested_search_hits"] = _query(
        f"""SELECT session_id, {_term("pagepath")} AS query, sku AS doc, {_big("click")},
                   CAST(row_number() OVER (PARTITION BY session_id ORDER BY product_pos) AS BIGINT)
                     AS position
            FROM visit_products WHERE sku <> '(not set)' AND {_search_page("pagepath")}"""
    )
    out["purchased_from_search"] = _query(
        f"""SELECT v.session_id, CAST(count(p.sku) AS BIGINT) AS searched,
                   CAST(count(CASE WHEN v.event_type = 'purchase' AND p.number = v.k
                              THEN 1 END) AS BIGINT) AS purchased,
                   min_by(p.sku, p.product_pos) AS first_sku,
                   coalesce(max(CASE WHEN v.event_type = 'purchase' AND p.number = v.k
                                THEN p.sku END), '') AS purchased_skus
            FROM visits v LEFT JOIN visit_products p ON p.session_id = v.session_id
              AND p.sku <> '(not set)' AND {_search_page("p.pagepath")}
            GROUP BY v.session_id"""
    )
    out["session_lists"] = _query(f"SELECT {_list_columns()} FROM event_lists")
    out["session_lists_sampled"] = _query(f"SELECT {_list_columns()} FROM event_sampled")
    out["list_arrays"] = _query(
        """SELECT session_id, query, CAST(count(*) AS BIGINT) AS n_docs,
                  max(click) = 1 AS any_click, CAST(sum(purchase) AS BIGINT) AS purchases,
                  max(CASE WHEN list_pos = 1 THEN doc END) AS first_doc,
                  string_agg(doc, ',' ORDER BY list_pos) AS docs
           FROM event_lists GROUP BY session_id, query"""
    )
    out["visitor_context"] = _query(
        f"SELECT fv, channel_group, {_big('avg_ticket')}, {_round('raw_ticket')} "
        "FROM event_visitors"
    )
    contexts = f"""SELECT {_CONTEXT}, CAST(count(DISTINCT session_id) AS BIGINT) AS n_sessions,
       CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(click) AS BIGINT) AS n_clicks
       FROM {{}} GROUP BY {_CONTEXT}"""
    out["train_contexts"] = _query(contexts.format("event_sets"))
    out["order_contexts"] = _query(contexts.format("order_sets"))
    out["validation_contexts"] = _query(
        f"""SELECT {_CONTEXT}, sku, CAST(count(*) AS BIGINT) AS n FROM validation_all
            GROUP BY {_CONTEXT}, raw_ticket, sku"""
    )
    judged = f"doc, {_round('alpha', 'sigma', 'judgment')}"
    graded = f"doc, {_round('judgment')}, {_big('grade')}"
    out["sdbn_judgments"] = _query(f"SELECT query, {judged} FROM event_sdbn")
    out["graded_judgments"] = _query(f"SELECT query, {graded} FROM event_graded")
    out["context_graded_judgments"] = _query(f"SELECT {_CONTEXT}, {graded} FROM context_graded")
    out["order_lists"] = _query(f"SELECT {_list_columns()} FROM order_lists")
    out["order_sdbn_judgments"] = _query(f"SELECT query, {judged} FROM order_sdbn")
    out["order_graded_judgments"] = _query(f"SELECT query, {graded} FROM order_graded")
    out["judgment_percentiles"] = _query(
        "SELECT query, "
        + ", ".join(f"round(p[{i + 1}], 6) AS p{20 * (i + 1)}" for i in range(5))
        + """ FROM (SELECT query, quantile_cont(judgment, [0.2, 0.4, 0.6, 0.8, 1.0]) AS p
              FROM order_sdbn GROUP BY query) q"""
    )
    out["context_keys"] = _query(
        f"""SELECT DISTINCT concat('search_term:', search_term, '|channel_group:', channel_group,
               '|customer_avg_ticket:', customer_avg_ticket) AS key, {_CONTEXT} FROM event_sets"""
    )
    shown = "doc, " + _big("click", "purchase", "list_pos", "last_click")
    out["clickstream_round_trip"] = _query(
        f"SELECT {_CONTEXT}, {shown}, CAST(count(*) AS BIGINT) AS n FROM event_sets GROUP BY ALL"
    )
    out["validation_round_trip"] = out["validation_contexts"]
    out["judgment_rows"] = _query(f"SELECT {_CONTEXT}, doc, {_big('grade')} FROM context_graded")
    out["raw_judgments"] = _query(f"SELECT {_CONTEXT}, doc, {_round('judgment')} FROM context_sdbn")
    out["dbn_one_step"] = _after("event_lists", _one_step())
    out["dbn_judgments"] = _after("event_lists", _em(10, "event_lists"))
    out["order_dbn_judgments"] = _after("order_lists", _em(10, "order_lists"))
    out["product_channel"] = _query(
        f"SELECT session_id, channel, sku, category, name, impressions, clicks, {_round('price')}"
        " FROM per_session"
    )
    rates = ", ".join(
        [_round("price"), "impressions", "clicks", _round("ctr"), _round(*_rates())]
    )
    out["catalog_rows"] = _query(f"SELECT sku, channel, name, category, {rates} FROM catalog_rows")
    out["documents_strict"] = _query(
        """SELECT sku, name, category, round(CAST(CAST(price AS FLOAT) AS DOUBLE), 6) AS price,
                  impressions, clicks FROM catalog"""
    )
    out["catalog_last"] = _query(f"SELECT sku, name, category, {rates} FROM catalog_last")
    out["catalog_docs"] = _query(f"SELECT sku, name, category, {rates} FROM catalog")
    out["upsert_catalog"] = _query(
        """SELECT coalesce(n.sku, CAST(p.p_partkey AS VARCHAR)) AS sku,
                  CASE WHEN n.sku IS NULL THEN p.p_name ELSE n.name END AS name,
                  round(CASE WHEN n.sku IS NULL THEN p.p_retailprice ELSE n.price END, 6) AS price
           FROM part p FULL JOIN catalog n ON n.sku = CAST(p.p_partkey AS VARCHAR)"""
    )
    out["bm25_judged"] = _query(
        """SELECT g.query, g.doc, round(coalesce(s.bm25_name, 0), 6) AS bm25_name,
                  round(coalesce(s.bm25_category, 0), 6) AS bm25_category
           FROM event_graded g JOIN catalog c ON c.sku = g.doc
           LEFT JOIN judged_scores s ON s.search_term = g.query AND s.sku = g.doc"""
    )
    out["bm25_documents"] = f"""
WITH words AS (SELECT doc_id, unnest({_tokens("text")}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS len FROM words GROUP BY doc_id),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
totals AS (SELECT count(*) AS n, avg(len) AS average FROM lengths),
asked AS (SELECT item_id, term, count(*) AS times FROM
          (SELECT item_id, unnest({_tokens("text")}) AS term FROM benchmark) b
          GROUP BY item_id, term),
sizes AS (SELECT item_id, count(*) AS n_terms FROM asked GROUP BY item_id)
SELECT a.item_id, t.doc_id, round(sum(a.times * ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5))
         * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * l.len / s.average))), 6) AS score
FROM asked a JOIN tf t ON t.term = a.term JOIN df d ON d.term = a.term
JOIN lengths l ON l.doc_id = t.doc_id JOIN sizes z ON z.item_id = a.item_id CROSS JOIN totals s
GROUP BY a.item_id, t.doc_id, z.n_terms HAVING count(*) = z.n_terms"""
    out["match_all_terms"] = f"""
WITH asked AS (SELECT DISTINCT p_name AS search_term FROM part
               UNION SELECT DISTINCT concat(p_type, ' ', p_name) FROM part
               UNION SELECT CAST(p_partkey AS VARCHAR) FROM part),
words AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS sku, term FROM (
            SELECT p_partkey, unnest({_tokens("p_name")}) AS term FROM part
            UNION ALL SELECT p_partkey, unnest({_tokens("p_type")}) AS term FROM part) w),
terms AS (SELECT DISTINCT search_term, term FROM
          (SELECT search_term, unnest({_tokens("search_term")}) AS term FROM asked) t)
SELECT t.search_term, w.sku FROM terms t JOIN words w ON w.term = t.term
JOIN (SELECT search_term, count(*) AS n FROM terms GROUP BY search_term) s
  ON s.search_term = t.search_term
GROUP BY t.search_term, w.sku, s.n HAVING count(*) = s.n
UNION SELECT search_term, CAST(p_partkey AS VARCHAR) FROM asked
JOIN part ON CAST(p_partkey AS VARCHAR) = search_term"""
    out["first_pass_topk"] = _query(
        "SELECT search_term, sku, round(score, 6) AS score, CAST(pos AS BIGINT) AS pos "
        "FROM first_pass WHERE pos < 1000"
    )
    out["rescored_topk"] = _query(
        f"SELECT set_name, {_CONTEXT}, sku, round(final, 6) AS score, CAST(pos AS BIGINT) AS pos "
        "FROM rescored WHERE pos < 1000"
    )
    features = _round("f1", "f2", "f3", "f4")
    out["feature_log"] = _query(
        f"SELECT {_CONTEXT}, sku AS doc, {_big('grade')}, {features} FROM features"
    )
    out["feature_log_normalised"] = _query(
        f"SELECT {_CONTEXT}, sku AS doc, {_big('grade', 'qid')}, {features} FROM normalised"
    )
    cells = ", ".join(f"'{i}:' || CAST(CAST(f{i} AS DECIMAL(18, 6)) AS VARCHAR)" for i in (1, 2, 3, 4))
    out["letor_rows"] = _query(
        f"""SELECT CAST(qid AS BIGINT) AS qid, sku AS doc,
                   concat_ws(chr(9), CAST(grade AS VARCHAR), 'qid:' || qid, {cells}) AS line
            FROM numbered_features"""
    )
    out["ensemble_scores"] = _query(
        f"SELECT {_CONTEXT}, sku AS doc, round(CAST({_SMALL_MODEL} AS DOUBLE), 6) AS score "
        "FROM features"
    )
    out["ensemble_scores_many_trees"] = _query(
        f"SELECT {_CONTEXT}, sku AS doc, round(CAST(30 * {_SMALL_MODEL} AS DOUBLE), 6) AS score "
        "FROM features"
    )
    # kinds of missing values by document, as in the query
    odd = """(SELECT search_term, channel_group, customer_avg_ticket, sku,
        CASE CAST(sku AS BIGINT) % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 'nan'::DOUBLE ELSE f1 END AS f1,
        CASE CAST(sku AS BIGINT) % 4 WHEN 0 THEN 0.0 ELSE f2 END AS f2,
        CASE CAST(sku AS BIGINT) % 4 WHEN 0 THEN 0.0 WHEN 2 THEN 0.0 ELSE f3 END AS f3,
        CASE CAST(sku AS BIGINT) % 4 WHEN 1 THEN f4 ELSE 0.0 END AS f4 FROM features)"""
    out["ensemble_scores_missing"] = _query(
        f"""SELECT {_CONTEXT}, sku AS doc, round(CAST({_SMALL_MODEL} AS DOUBLE), 6) AS few,
                   round(CAST(30 * {_SMALL_MODEL} AS DOUBLE), 6) AS many FROM {odd} o"""
    )
    out["model_nodes"] = out["ensemble_scores"]
    six = ["f1", "f2", "f3", "f4", "CAST(grade AS DOUBLE)", "(f3 - f1)"]
    shares = ", ".join(
        f"""round(CASE WHEN sum(abs({x})) OVER w > 0 THEN {x} / sum(abs({x})) OVER w
                  ELSE 0.0 END, 6) AS f{i}"""
        for i, x in enumerate(six, 1)
    )
    out["normalised_wide"] = _query(
        f"""SELECT {_CONTEXT}, sku AS doc, {_big('qid')}, {shares}
            FROM numbered_features WINDOW w AS (PARTITION BY qid)"""
    )
    cut = ", ".join(f"round(CAST(CAST(f{i} AS DECIMAL(18, 6)) AS DOUBLE), 6) AS f{i}" for i in (1, 2, 3, 4))
    out["letor_parsed"] = _query(f"SELECT {_big('qid', 'grade')}, {cut} FROM numbered_features")
    out["lambdamart_first_tree"] = _after("numbered_features", _FIRST_TREE)
    out["lambdamart_missing"] = _after("numbered_features", _MISSING_TREE)
    out["mart_first_tree"] = _after("numbered_features", _point_tree("0.1"))
    out["forest_first_tree"] = _after("numbered_features", _point_tree("1.0"))
    out["line_search"] = _after("numbered_features", _LINE_SEARCH)
    out["letor_sparse"] = out["letor_parsed"]
    out["lambda_gradients"] = _after("numbered_features", _GRADIENTS)
    out["err_documents"] = """
SELECT source, round(sum(gain * passed / place), 6) AS err FROM (
  SELECT *, exp(coalesce(sum(ln(1 - gain)) OVER (PARTITION BY source ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS passed
  FROM (SELECT d.source, (pow(2, 4 * l.quality) - 1) / 16 AS gain,
               row_number() OVER (PARTITION BY d.source ORDER BY d.n_chars DESC, d.doc_id) AS place
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id) r
  WHERE place <= 10) p GROUP BY source"""
    out["err_judgments"] = _query(
        """SELECT query, round(sum(gain * passed / place), 6) AS err FROM (
  SELECT *, exp(coalesce(sum(ln(1 - gain)) OVER (PARTITION BY query ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS passed
  FROM (SELECT query, (pow(2, grade) - 1) / 16 AS gain,
               row_number() OVER (PARTITION BY query ORDER BY round(alpha, 9) DESC, doc) AS place
        FROM order_graded) r
  WHERE place <= 10) p GROUP BY query"""
    )
    out["mean_percentile_rank"] = _query(_rank("listed"))
    out["percentile_rank_full_lists"] = out["mean_percentile_rank"]
    out["evaluated_model"] = _query(_rank("rescored"))
    out["temporal_split"] = _query(
        """SELECT CASE WHEN day(session_date) <= 10 THEN 'train'
                       WHEN day(session_date) <= 20 THEN 'validation' ELSE 'test' END AS set_name,
                  CAST(count(*) AS BIGINT) AS n_hits,
                  CAST(count(DISTINCT session_id) AS BIGINT) AS n_sessions
           FROM event_hits WHERE session_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
           GROUP BY 1"""
    )
    out["hit_scalars"] = _query(
        f"""SELECT session_id, CAST(hit_pos AS BIGINT) AS hit_pos, {_term("pagepath")} AS query,
               {_search_page("pagepath")} AS on_search, {_channel_group("channel")} AS channel_group,
               replace(category, '/', ' ') AS category, round(price_micros / 1e6, 6) AS price,
               CAST(round(price_micros / 2e6) AS BIGINT) AS half_price,
               CAST(round(-price_micros / 2e6) AS BIGINT) AS minus_half_price,
               CAST(CASE WHEN is_click THEN 1 ELSE 0 END AS BIGINT) AS click,
               CAST(CASE WHEN is_impression THEN 1 WHEN NOT is_impression THEN 0 END AS BIGINT)
                 AS impression,
               round(ln(1 + abs(price_micros / 1e6 - 40)), 6) AS price_distance,
               round({_hash("session_id", "hit_pos")}, 6) AS fraction
            FROM event_hits WHERE sku <> '(not set)'"""
    )
    out["sql_functions"] = _query(
        f"""SELECT {_channel_group("channel")} AS channel_group, CAST(count(*) AS BIGINT) AS n,
               round(sum(ln(1 + abs(price_micros / 1e6 - 40))), 6) AS distance
            FROM event_hits WHERE session_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-14'
            GROUP BY 1"""
    )
    out["best_trial"] = """
SELECT trial, rank_val FROM (
  SELECT trial, rank_val, row_number() OVER (ORDER BY rank_val, trial) AS place FROM (
    SELECT CAST(substr(d.source, 4) AS BIGINT) AS trial, round(avg(l.quality), 6) AS rank_val
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source) t) r WHERE place = 1"""
    out["upsert_catalog_buckets"] = out["upsert_catalog"]
    # the nested log holds the same sessions
    for name in ("session_lists", "session_lists_sampled", "visitor_context", "product_channel", "validation_contexts"):
        out[f"nested_{name}"] = out[name]
    out["dense_list_ids"] = _query(
        f"""SELECT {_CONTEXT}, CAST(row_number() OVER (ORDER BY {_CONTEXT}) - 1 AS BIGINT) AS qid
            FROM event_sets GROUP BY {_CONTEXT}"""
    )
    return out
