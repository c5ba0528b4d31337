"""The registered queries in SQL, over the base tables only."""

from __future__ import annotations

# Tables derived from the base tables (see FIXTURES.md) and shared intermediate results.
# Each entry may use the entries before it.
CTES: dict[str, str] = {
    "items": """
select p.p_partkey as item_id, p.p_name as title,
  case when p.p_partkey % 23 = 0 then null else cast(1990 + (p.p_partkey * 7) % 31 as int) end as release_year,
  case when p.p_partkey % 5 < 3 then null when p.p_partkey % 5 = 3 then p.p_type else 'UNKNOWN_CAT' end as category_id,
  case when p.p_partkey % 4 = 0 then '' when p.p_partkey % 4 = 1 then null else concat('img/', cast(p.p_partkey as varchar(20))) end as cover_url,
  case p.p_partkey % 3 when 0 then 'catalog' when 1 then 'universe' else 'finder' end as source_type,
  case when p.p_partkey % 11 = 0 then 'upcoming' else 'released' end as release_state
from part p""",
    "item_tags": """
select p_partkey as item_id, split_part(p_name,' ',1) as tag_id from part where p_partkey % 13 <> 0
union select p_partkey, split_part(p_name,' ',2) from part where p_partkey % 13 <> 0
union select p_partkey, lower(p_type) from part where p_partkey % 13 <> 0""",
    "tags": "select distinct tag_id from item_tags where tag_id <> 'rod'",
    "item_platforms": """
select distinct l.l_partkey as item_id, n.n_name as platform_id
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey join nation n on s.s_nationkey = n.n_nationkey""",
    "platforms": "select n_name as platform_id, concat('platform ', lower(n_name)) as name from nation",
    "categories": "select distinct p_type as category_id, concat('cat ', lower(p_type)) as name from part",
    "signals": """
select l_partkey as item_id,
  case when l_partkey % 4 <> 0 then round(max(l_quantity) / 50, 6) end as best_critic_score,
  case when l_partkey % 3 <> 0 then round(sum(cast(round(l_discount * 100) as bigint)) / count(*) / 10, 6) end as best_user_score,
  count(*) as critic_review_count,
  case when l_partkey % 6 <> 0 then count(distinct l_orderkey) end as user_review_count,
  case when l_partkey % 7 <> 0 then round(avg(cast(case when l_returnflag = 'N' then 1 else 0 end as double)), 6) end as critic_positive_ratio,
  case when l_partkey % 8 <> 0 then round(avg(cast(case when l_linestatus = 'F' then 1 else 0 end as double)), 6) end as user_positive_ratio,
  max(cast(round(l_extendedprice * 100) as bigint)) / 100000000e0 as max_sales_millions,
  case when l_partkey % 9 <> 0 then sum(cast(round(l_extendedprice * 100) as bigint)) / 100000000e0 end as total_sales_millions,
  cast((l_partkey * 37) % 101 as int) as data_confidence_score,
  l_partkey % 2 = 0 as has_external_id, l_partkey % 3 = 0 as has_company, l_partkey % 5 = 0 as has_age_rating,
  l_partkey % 7 < 4 as has_summary, l_partkey % 9 <> 0 as has_sales, l_partkey % 11 < 2 as has_review_sentiment
from lineitem where l_partkey % 10 <> 7 group by l_partkey""",
    "dup_candidates": """
select group_key, item_id from (select concat(p_name, '|', p_brand) as group_key, p_partkey as item_id,
  count(*) over (partition by p_name, p_brand) as n from part) x where n > 1""",
    "dup_groups": """
select d.group_key, case when count(distinct i.release_year) > 1 then 'check_years' else 'merge' end as suggested_review,
  case when count(*) % 3 = 0 then 'resolved' else 'needs_review' end as status,
  count(*) as candidate_count, count(distinct i.release_year) as known_year_count
from dup_candidates d join items i on d.item_id = i.item_id group by d.group_key""",
    "external_matches": """
select event_id as match_id, event_id % 2000 as item_id, case when event_type in ('view','click') then 'source_a' else 'source_b' end as source,
  concat('title ', cast(event_id as varchar(20))) as source_title, cast(least(100, floor(value)) as int) as confidence_score,
  case when value >= 70 then 'auto_approved' when value >= 20 then 'needs_review' else 'rejected' end as status,
  event_type as matched_by from events""",
    "user_likes": """
select distinct o.o_custkey as user_id, l.l_partkey as item_id from orders o join lineitem l on o.o_orderkey = l.l_orderkey
where l.l_returnflag = 'N'""",
    "user_exclusions": """
select distinct o.o_custkey as user_id, l.l_partkey as item_id from orders o join lineitem l on o.o_orderkey = l.l_orderkey
where l.l_returnflag = 'R'""",
    "ab_units": """
select user_id as unit_id, avg(value) filter (where event_type = 'view') as metric_a,
  avg(value) filter (where event_type = 'click') as metric_b
from events group by user_id
having avg(value) filter (where event_type = 'view') is not null
   and avg(value) filter (where event_type = 'click') is not null""",
    "medians": """
select median(s.best_critic_score) as critic, median(s.best_user_score) as usr
from items i left join signals s on i.item_id = s.item_id""",
    "filled": """
select i.item_id, i.title, coalesce(i.release_year, 0) as release_year, i.category_id,
  coalesce(s.best_critic_score, m.critic) as best_critic_score,
  coalesce(s.best_user_score, m.usr) as best_user_score,
  coalesce(s.critic_review_count, 0) as critic_review_count,
  coalesce(s.user_review_count, 0) as user_review_count,
  coalesce(s.critic_positive_ratio, 0.5e0) as critic_positive_ratio,
  coalesce(s.user_positive_ratio, 0.5e0) as user_positive_ratio,
  coalesce(s.max_sales_millions, 0e0) as max_sales_millions,
  coalesce(s.total_sales_millions, 0e0) as total_sales_millions,
  coalesce(s.data_confidence_score, 50) as data_confidence_score,
  coalesce(s.has_external_id, false) as has_external_id, coalesce(s.has_company, false) as has_company,
  coalesce(s.has_age_rating, false) as has_age_rating, coalesce(s.has_summary, false) as has_summary,
  coalesce(s.has_sales, false) as has_sales, coalesce(s.has_review_sentiment, false) as has_review_sentiment
from items i left join signals s on i.item_id = s.item_id cross join medians m""",
    "features": """
select *, log10(total_sales_millions + 0.001e0) as log_sales,
  critic_review_count + user_review_count as total_review_count from filled""",
    "scored": """
select *,
  best_critic_score * 0.25e0 + best_user_score * 0.20e0 + log_sales * 0.15e0
    + critic_positive_ratio * 0.15e0 + user_positive_ratio * 0.10e0
    + data_confidence_score / 100e0 * 0.15e0 as popularity_score,
  cast(has_external_id as int) * 0.20e0 + cast(has_company as int) * 0.15e0
    + cast(has_age_rating as int) * 0.15e0 + cast(has_summary as int) * 0.15e0
    + cast(has_sales as int) * 0.15e0 + cast(has_review_sentiment as int) * 0.20e0 as richness_score
from features""",
    "bin": """
select item_id, 'tag' as kind, tag_id as feature from item_tags where tag_id in (select tag_id from tags)
union select item_id, 'platform', platform_id from item_platforms""",
    "n_features": "select item_id, cast(count(*) as double) as n from bin group by item_id",
    "gaps": """
select i.item_id, i.title, concat_ws(',',
    case when i.category_id is null or i.category_id = '' then 'no_category' end,
    case when i.cover_url is null or i.cover_url = '' then 'no_cover' end,
    case when i.release_year is null then 'no_year' end,
    case when i.item_id not in (select item_id from item_tags) then 'no_tags' end,
    case when i.item_id not in (select item_id from item_platforms) then 'no_platforms' end) as missing_issues,
  s.data_confidence_score, s.popularity_score
from items i join scored s on i.item_id = s.item_id""",
    # Profile recommendations.
    "profiles": """
select * from (values ('P1','small'), ('P1','gear'), ('P1','promo'), ('P2','red'), ('P2','bolt'),
  ('P2','no_such_tag'), ('P3','no_such_tag')) t(profile, tag_id)""",
    "grid": """
select * from (values (0, 0.6e0, 0.3e0, 0.1e0), (1, 0.5e0, 0.4e0, 0.1e0), (2, 0.4e0, 0.5e0, 0.1e0),
  (3, 0.7e0, 0.2e0, 0.1e0), (4, 0.5e0, 0.3e0, 0.2e0), (5, 0.4e0, 0.4e0, 0.2e0), (6, 0.3e0, 0.6e0, 0.1e0),
  (7, 0.6e0, 0.2e0, 0.2e0), (8, 0.5e0, 0.35e0, 0.15e0), (9, 0.45e0, 0.45e0, 0.1e0)) t(setting, alpha, beta, gamma)""",
    "relevant": """
select distinct p.profile, b.item_id from profiles p join bin b on p.tag_id = b.feature""",
    "present": """
select profile, cast(count(distinct tag_id) as double) as present from profiles
where tag_id in (select feature from bin) group by profile""",
    "matched": """
select p.profile, b.item_id, count(distinct p.tag_id) as matched
from profiles p join bin b on p.tag_id = b.feature group by p.profile, b.item_id""",
    "profile_scores": """
select g.setting, p.profile, s.item_id, s.title, s.popularity_score, s.data_confidence_score,
  case when r.present is null then s.popularity_score
    else g.alpha * (coalesce(m.matched, 0) / r.present) + g.beta * s.popularity_score
      - (100e0 - s.data_confidence_score) / 100e0 * g.gamma end as final_score,
  case when r.present is null then 0e0 else coalesce(m.matched, 0) / r.present end as content_score,
  case when r.present is null then 0e0 else (100e0 - s.data_confidence_score) / 100e0 * g.gamma end as confidence_penalty
from grid g cross join (select distinct profile from profiles) p cross join scored s
left join present r on r.profile = p.profile
left join matched m on m.profile = p.profile and m.item_id = s.item_id""",
    "grid_recs": """
select * from (select *, row_number() over (partition by setting, profile
  order by round(final_score, 9) desc, item_id) as rank from profile_scores) t where rank <= 20""",
    "recs": "select * from grid_recs where setting = 1",
    "ks": "select * from (values (1), (3), (5), (10), (20)) t(k)",
    "hits": """
select r.setting, r.profile, r.rank, r.item_id, case when v.item_id is null then 0 else 1 end as hit,
  sum(case when v.item_id is null then 0 else 1 end) over (partition by r.setting, r.profile order by r.rank) as run
from grid_recs r left join relevant v on r.profile = v.profile and r.item_id = v.item_id""",
    "list_metrics": """
select l.setting, l.profile, k.k, coalesce(sum(h.hit), 0) / cast(k.k as double) as precision,
  case when n.n is null then 0e0 else sum(h.hit) / cast(n.n as double) end as recall,
  case when n.n is null then 0e0 else sum(h.hit / log2(h.rank + 1e0))
    / list_sum(list_transform(range(1, least(n.n, k.k) + 1), lambda i: 1e0 / log2(i + 1e0))) end as ndcg,
  case when n.n is null then 0e0 else sum(h.hit * h.run / cast(h.rank as double)) / least(n.n, k.k) end as average_precision,
  max(h.hit) as hit
from (select distinct setting, profile from grid_recs) l cross join ks k
join hits h on h.setting = l.setting and h.profile = l.profile and h.rank <= k.k
left join (select profile, count(*) as n from relevant group by profile) n on n.profile = l.profile
group by l.setting, l.profile, k.k, n.n""",
    "evaluation": """
select setting, x.metric, k, x.value from (
  select setting, k, unnest([{'metric': 'precision', 'value': avg(precision)},
    {'metric': 'recall', 'value': avg(recall)}, {'metric': 'ndcg', 'value': avg(ndcg)}]) as x
  from list_metrics group by setting, k)
union all select setting, 'map', 20, avg(average_precision) from list_metrics where k = 20 group by setting
union all select setting, 'hit_rate', 20, avg(hit) from list_metrics where k = 20 group by setting
union all select setting, 'coverage', null, count(distinct item_id) / (select cast(count(*) as double) from scored) from grid_recs group by setting
union all select setting, 'novelty', null, avg(-log2(popularity_score)) filter (where popularity_score > 0) from grid_recs group by setting""",
    "grid_result": """
select g.setting, g.alpha, g.beta, g.gamma,
  max(e.value) filter (where metric = 'precision' and k = 5) as precision_at_5,
  max(e.value) filter (where metric = 'ndcg' and k = 5) as ndcg_at_5,
  max(e.value) filter (where metric = 'map') as map_at_20,
  max(e.value) filter (where metric = 'coverage') as coverage,
  max(e.value) filter (where metric = 'novelty') as novelty
from grid g join evaluation e on e.setting = g.setting group by g.setting, g.alpha, g.beta, g.gamma""",
    # Set cosine of two items: the cosine of their full-rank embeddings.
    "cosines": """
select a.item_id as item_a, b.item_id as item_b, count(*) / sqrt(na.n * nb.n) as sim
from bin a join bin b on a.kind = b.kind and a.feature = b.feature
join n_features na on na.item_id = a.item_id join n_features nb on nb.item_id = b.item_id
group by a.item_id, b.item_id, na.n, nb.n""",
    # Hybrid recommendations: the profile of a user counts the features of the liked items.
    "taste": """
select l.user_id, b.kind, b.feature, cast(count(*) as double) as c
from user_likes l join bin b on l.item_id = b.item_id group by l.user_id, b.kind, b.feature""",
    "taste_norm": "select user_id, sqrt(sum(c * c)) as norm from taste group by user_id",
    "taste_cos": """
select t.user_id, b.item_id, sum(t.c) / (any_value(w.norm) * sqrt(any_value(n.n))) as content
from taste t join bin b on t.kind = b.kind and t.feature = b.feature
join taste_norm w on w.user_id = t.user_id join n_features n on n.item_id = b.item_id
group by t.user_id, b.item_id""",
    "hybrid_scores": """
select g.setting, u.user_id, s.item_id, s.title, s.popularity_score, s.data_confidence_score,
  coalesce(t.content, 0e0) as content_score,
  (100e0 - s.data_confidence_score) / 100e0 * g.gamma as confidence_penalty,
  round(g.alpha * coalesce(t.content, 0e0) + g.beta * s.popularity_score
    - (100e0 - s.data_confidence_score) / 100e0 * g.gamma, 9) as final_score
from (select * from grid where setting = 1) g cross join (select distinct user_id from user_likes) u cross join scored s
left join taste_cos t on t.user_id = u.user_id and t.item_id = s.item_id
anti join user_likes l on l.user_id = u.user_id and l.item_id = s.item_id""",
    "hybrid": """
select *, row_number() over (partition by setting, user_id order by final_score desc, item_id) as rank
from hybrid_scores qualify rank <= 20""",
}


def _with(names: str, body: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they use, in definition order."""
    import re
    order, needed = list(CTES), set(names.split())
    for name in reversed(order):
        if name in needed:
            needed |= {n for n in order[:order.index(name)]
                       if re.search(rf"\b(from|join)\s+{n}\b", CTES[name])}
    parts = [f"{n} as ({CTES[n]}\n)" for n in order if n in needed]
    return "with " + ",\n".join(parts) + "\n" + body


_R = "round({0}, 9) as {0}"


def _rounded(*names: str) -> str:
    return ", ".join(_R.format(n) for n in names)


_FEATURE_COLUMNS = f"""item_id, title, release_year, category_id,
  {_rounded('best_critic_score', 'best_user_score')}, critic_review_count, user_review_count,
  {_rounded('critic_positive_ratio', 'user_positive_ratio', 'max_sales_millions', 'total_sales_millions')},
  data_confidence_score, has_external_id, has_company, has_age_rating, has_summary, has_sales,
  has_review_sentiment, {_rounded('log_sales')}, total_review_count"""

# The tag and platform vocabulary of the derived catalog.
_TAGS = ("anvil blue bolt cold economy gear gizmo hot large medium new old plate promo red ring "
         "small standard widget").split()
_PLATFORMS = sorted(f"NATION_{i}" for i in range(25))


def _flags(kind: str, names: list[str]) -> str:
    return ", ".join(
        f"max(case when kind = '{kind}' and feature = '{n}' then 1 else 0 end) as \"{n}\""
        for n in names)


def _distribution(table: str, column: str) -> str:
    return _with(table, f"select {column}, count(*) as row_count from {table} group by {column}")


def _histogram(table: str, column: str, bins: int) -> str:
    return _with(table, f"""
select b.bin, round(e.lo + b.bin * ((e.hi - e.lo) / {bins}), 9) as bin_start,
  round(e.lo + (b.bin + 1) * ((e.hi - e.lo) / {bins}), 9) as bin_end, coalesce(c.n, 0) as item_count
from (select cast(range as int) as bin from range({bins})) b
cross join (select cast(min({column}) as double) as lo, cast(max({column}) as double) as hi from {table}) e
left join (select cast(least(floor(({column} - lo) * {bins} / (hi - lo)), {bins} - 1) as int) as bin, count(*) as n
  from {table} cross join (select cast(min({column}) as double) as lo, cast(max({column}) as double) as hi from {table}) x
  where {column} is not null group by 1) c on c.bin = b.bin""")


_GAP_TEXT = _with("gaps", """
select item_id, title, missing_issues, data_confidence_score,
  round(cast(cast(popularity_score as float) as double), 6) as popularity_score
from gaps where missing_issues <> ''""")

_REC_COLUMNS = ("cast(rank as int) as rank, item_id, title, " + _rounded(
    "final_score", "content_score", "popularity_score", "confidence_penalty")
    + ", data_confidence_score as data_confidence")

# Popularity order for all users of ``cold`` without their exclusions.
_COLD = """
select user_id, cast(rank as int) as rank, item_id, title, round(popularity_score, 9) as final_score, 0e0 as content_score,
  round(popularity_score, 9) as popularity_score, 0e0 as confidence_penalty,
  data_confidence_score as data_confidence
from (select u.user_id, s.*, row_number() over (partition by u.user_id
    order by round(s.popularity_score, 9) desc, s.item_id) as rank
  from {users} u cross join scored s {anti})
where rank <= {k}"""
_ANTI = "anti join user_exclusions x on x.user_id = u.user_id and x.item_id = s.item_id"


def _two(x: str) -> str:
    return f"printf('%.2f', floor(round({x}, 9) * 100 + 0.5) / 100)"


_RULE = """case when t = '' then 'no score is out of the ordinary' else t end"""
_RULE_PARTS = f"""concat_ws('; ',
  case when content_score > 0.05 then 'content_score ' || {_two('content_score')} || ' > 0.05' end,
  case when popularity_score > 0.5 then 'popularity_score ' || {_two('popularity_score')} || ' > 0.50' end,
  case when data_confidence_score >= 70 then 'data_confidence ' || data_confidence_score || '.00 >= 70.00'
       when data_confidence_score < 40 then 'data_confidence ' || data_confidence_score || '.00 < 40.00' end,
  case when confidence_penalty > 0.02 then 'confidence_penalty ' || {_two('confidence_penalty')} || ' > 0.02' end)"""
_TEMPLATE = (f"'content_score=' || {_two('content_score')} || "
             f"' popularity_score=' || {_two('popularity_score')}")

# Rational approximation of erf, as in the operator.
_ERF = ("(1e0 - (((((1.061405429e0 * t + -1.453152027e0) * t + 1.421413741e0) * t + -0.284496736e0) * t "
        "+ 0.254829592e0) * t) * exp(-x * x))")


def _grouped_dcg(source: str, score: str, name: str) -> str:
    """DCG per group and k with averaged gains for ties."""
    return f"""
{name}_ranked as (select query_group, label, {score} as sc,
  row_number() over (partition by query_group order by {score} desc) as pos from {source}),
{name} as (select query_group, k, sum(mean_gain * discount) as dcg from (
  select r.query_group, k.k, r.sc, avg(r.label) as mean_gain,
    sum(case when r.pos <= k.k then 1e0 / log2(r.pos + 1e0) else 0e0 end) as discount
  from {name}_ranked r cross join ks k group by r.query_group, k.k, r.sc) group by query_group, k)"""


_HELD = f"""every_like as ({CTES['user_likes']}
),
marked as (select *, cast('0x' || substr(md5('42:' || user_id || ':' || item_id), 1, 8) as bigint) % 5 = 0 as held
  from every_like),
split as (select * from marked where user_id in (
  select user_id from marked group by user_id having bool_or(held) and not bool_and(held))),
user_likes as (select user_id, item_id from split where not held
)"""

_HELD_METRICS = """, hits as (select h.setting, h.user_id, h.rank, case when s.item_id is null then 0 else 1 end as hit,
    sum(case when s.item_id is null then 0 else 1 end) over (partition by h.setting, h.user_id order by h.rank) as run
  from {lists} h left join split s on s.held and s.user_id = h.user_id and s.item_id = h.item_id),
sizes as (select user_id, count(*) as n from split where held group by user_id),
per_user as (select h.setting, h.user_id, k.k, sum(hit) / cast(k.k as double) as precision, sum(hit) / cast(s.n as double) as recall,
    sum(hit / log2(rank + 1e0)) / list_sum(list_transform(range(1, least(s.n, k.k) + 1), lambda i: 1e0 / log2(i + 1e0))) as ndcg,
    sum(hit * run / cast(rank as double)) / least(s.n, k.k) as average_precision, max(hit) as hit
  from hits h join (values (5), (10), (20)) k(k) on h.rank <= k.k join sizes s on s.user_id = h.user_id
  group by h.setting, h.user_id, k.k, s.n)
"""


def _held(names: str, body: str) -> str:
    """As _with, with the likes that are kept in place of all likes."""
    return _with(names, body).replace(f"user_likes as ({CTES['user_likes']}\n)", _HELD, 1)


ORACLES: dict[str, str] = {
    # Sources and sinks
    "export_table": _with("items", "select * from items"),
    "export_manifest": _with(
        "items item_tags tags item_platforms platforms categories signals dup_groups "
        "dup_candidates external_matches user_likes",
        "\nunion all ".join(
            f"select '{t}' as table_name, (select count(*) from {t}) as row_count, {n} as column_count"
            for t, n in (("items", 7), ("item_tags", 2), ("tags", 1), ("item_platforms", 2),
                         ("platforms", 2), ("categories", 2), ("signals", 16), ("dup_groups", 5),
                         ("dup_candidates", 2), ("external_matches", 7), ("user_likes", 2)))),
    "scan_counts": _with(
        "items signals item_platforms item_tags dup_groups dup_candidates external_matches",
        "\nunion all ".join(
            f"select '{t}' as table_name, count(*) as row_count from {t}"
            for t in ("items", "signals", "item_platforms", "item_tags", "dup_groups",
                      "dup_candidates", "external_matches"))),
    "adhoc_tag_counts": _with(
        "item_tags", "select tag_id, count(*) as cnt from item_tags group by tag_id"),
    "feature_matrix_roundtrip": _with("scored", f"""
select item_id, title, release_year, data_confidence_score,
  {_rounded('log_sales', 'popularity_score', 'richness_score')} from scored"""),
    "feature_matrix_bucketed": _with("scored item_tags", f"""
select item_id, {_rounded('log_sales', 'popularity_score')}, coalesce(n_tags, 0) as n_tags
from scored left join (select item_id, count(*) as n_tags from item_tags group by item_id) t using (item_id)"""),
    "precomputed_items": _with("scored", f"""
select s.item_id, s.title, {_R.format('popularity_score')}, s.data_confidence_score,
  1e0 as richness_score, 0 as release_year, 0 as n_tags, 0 as n_platforms, '' as category_id,
  '' as cover_url, cast(len(e.embedding) as int) as dimensions
from embeddings e join scored s on s.item_id = e.vec_id"""),
    "snapshot_flatten": _GAP_TEXT,
    "snapshot_roundtrip": _GAP_TEXT,
    "snapshot_summary": _with("gaps dup_groups external_matches scored", """
select 'quality_gaps' as table_name, count(*) as row_count, 5 as column_count, false as failed from gaps where missing_issues <> ''
union all select 'duplicate_groups', count(*), 4, false from dup_groups
union all select 'external_matches', least(count(*), 5000), 5, false from external_matches where confidence_score >= 70
union all select 'low_confidence_priorities', count(*), 4, false from scored where data_confidence_score < 30
union all select 'key_metrics', 0, 0, true"""),

    # SQL analytics
    "items_by_year": _with("items", """
select release_year, count(*) as item_count from items
where release_year is not null and release_year > 0 group by release_year"""),
    "top_platforms": _with("item_platforms platforms", """
select p.name, count(*) as item_count from item_platforms ip join platforms p on ip.platform_id = p.platform_id
group by p.name order by item_count desc, p.name limit 10"""),
    "avg_confidence_by_category": _with("signals items categories", """
select c.name as category, round(avg(s.data_confidence_score), 9) as avg_confidence, count(*) as item_count
from signals s join items i on s.item_id = i.item_id left join categories c on i.category_id = c.category_id
where i.category_id is not null group by c.name"""),
    "ranked_items_by_platform": _with("items item_platforms platforms signals", """
select i.item_id, i.title, p.name as platform, s.best_critic_score,
  cast(row_number() over (partition by ip.platform_id order by s.best_critic_score desc nulls last, i.item_id) as int) as rank_in_platform
from items i join item_platforms ip on i.item_id = ip.item_id join platforms p on ip.platform_id = p.platform_id
left join signals s on i.item_id = s.item_id where s.best_critic_score is not null
order by platform, rank_in_platform limit 50"""),
    "coverage_pivot": _with("items", """
select count(*) as total_items, cast(sum(case when category_id is not null then 1 else 0 end) as bigint) as with_category,
  cast(sum(case when cover_url <> '' then 1 else 0 end) as bigint) as with_cover,
  cast(sum(case when release_year is not null and release_year > 0 then 1 else 0 end) as bigint) as with_year,
  count(distinct item_id) as unique_items from items"""),
    "duplicate_summary": _with("dup_groups", """
select status, suggested_review, count(*) as group_count, cast(sum(candidate_count) as bigint) as total_candidates
from dup_groups group by status, suggested_review"""),
    "tag_rolling_rows": _with("item_tags items", """
select i.release_year, t.tag_id, t.item_id, count(*) over (partition by t.tag_id
  order by i.release_year, t.item_id rows between 5 preceding and current row) as rolling_row_count
from item_tags t join items i on t.item_id = i.item_id
where i.release_year is not null and i.release_year > 0
order by i.release_year, t.tag_id, t.item_id limit 100"""),
    "tag_rolling_years": _with("item_tags items", """
select distinct t.tag_id, i.release_year, count(*) over (partition by t.tag_id
  order by i.release_year range between 4 preceding and current row) as rolling_count
from item_tags t join items i on t.item_id = i.item_id
where i.release_year is not null and i.release_year > 0"""),
    "approx_tag_diversity": _with("item_tags", """
select tag_id, count(distinct item_id) as exact_item_count,
  abs(cast(approx_count_distinct(item_id) as bigint) - count(distinct item_id)) <= count(distinct item_id) * 0.15 as within_tol
from item_tags group by tag_id"""),
    "tag_diversity_merged": _with("items item_tags", """
select t.tag_id, cast(max(cast(i.source_type = 'catalog' as int)) + max(cast(i.release_state = 'released' as int)) as bigint) as n_parts,
  count(distinct t.item_id) as exact_item_count, true as within_tol
from item_tags t join items i on i.item_id = t.item_id
where i.source_type = 'catalog' or i.release_state = 'released' group by t.tag_id"""),

    # Quality audit
    "coverage_analysis": _with("items item_tags", """
select count(*) as total_items, round(count(*) filter (where category_id is null) * 100e0 / count(*), 9) as no_category,
  round(count(*) filter (where cover_url = '' or cover_url is null) * 100e0 / count(*), 9) as no_cover,
  round(count(*) filter (where release_year is null) * 100e0 / count(*), 9) as no_year,
  round(count(*) filter (where n is null) * 100e0 / count(*), 9) as no_tags,
  round(count(*) filter (where n = 0) * 100e0 / count(*), 9) as empty_tags,
  round(avg(n), 9) as avg_tags_per_item,
  round(count(*) filter (where title = '') * 100e0 / count(*), 9) as no_title
from items left join (select item_id, count(*) as n from item_tags group by item_id) t using (item_id)"""),
    "tags_per_item": _with("items item_tags", """
select i.item_id, cast(len(t.tags) as int) as tag_count, array_to_string(t.tags, ',') as tag_text, t.tags is null as no_list
from items i left join (select item_id, list_sort(list(tag_id)) as tags from item_tags group by item_id) t
on i.item_id = t.item_id"""),
    "source_distribution": _distribution("items", "source_type"),
    "release_state_distribution": _distribution("items", "release_state"),
    "signal_quality": _with("signals", """
select round(avg(data_confidence_score), 9) as avg_confidence, cast(median(data_confidence_score) as double) as median_confidence,
  min(data_confidence_score) as min_confidence, max(data_confidence_score) as max_confidence,
  round(count(*) filter (where data_confidence_score >= 70) * 100e0 / count(*), 9) as pct_high_confidence,
  round(count(*) filter (where data_confidence_score >= 40 and data_confidence_score < 70) * 100e0 / count(*), 9) as pct_medium_confidence,
  round(count(*) filter (where data_confidence_score < 40) * 100e0 / count(*), 9) as pct_low_confidence,
  round(count(best_critic_score) * 100e0 / count(*), 9) as has_scores_pct,
  round(count(*) filter (where has_sales) * 100e0 / count(*), 9) as has_sales_pct,
  round(count(*) filter (where has_review_sentiment) * 100e0 / count(*), 9) as has_sentiment_pct,
  round(count(*) filter (where has_external_id) * 100e0 / count(*), 9) as has_external_id_pct,
  round(count(*) filter (where has_company) * 100e0 / count(*), 9) as has_company_pct,
  round(count(*) filter (where has_summary) * 100e0 / count(*), 9) as has_summary_pct
from signals"""),
    "duplicate_analysis": _with("dup_groups dup_candidates", """
select count(*) as total_groups, count(*) filter (where known_year_count > 1) as groups_with_diff_years,
  max(candidate_count) as max_candidates_per_group, (select count(*) from dup_candidates) as total_candidates
from dup_groups"""),
    "dup_status_distribution": _distribution("dup_groups", "status"),
    "dup_review_distribution": _distribution("dup_groups", "suggested_review"),
    "external_match_analysis": _with("external_matches", """
select count(*) as total_matches, round(avg(confidence_score), 9) as avg_confidence,
  count(*) filter (where confidence_score >= 70 and status = 'auto_approved') as high_confidence_approved,
  count(*) filter (where status = 'needs_review') as needs_review from external_matches"""),
    "match_status_distribution": _distribution("external_matches", "status"),
    "match_source_distribution": _distribution("external_matches", "source"),
    "presence_split": _with("signals", """
select count(best_critic_score) as with_scores, count(*) - count(best_critic_score) as without_scores,
  count(*) filter (where has_sales) as with_sales, count(*) filter (where not coalesce(has_sales, false)) as without_sales
from signals"""),
    "coverage_buckets": _with("items signals", """
select aspect, round(pct, 9) as pct, case when pct > 50 then 'green' when pct > 20 then 'amber' else 'red' end as light from (
  select 'category' as aspect, count(category_id) * 100e0 / count(*) as pct from items
  union all select 'cover', count(*) filter (where cover_url <> '') * 100e0 / count(*) from items
  union all select 'year', count(release_year) * 100e0 / count(*) from items
  union all select 'scores', count(best_critic_score) * 100e0 / count(*) from signals
  union all select 'sales', count(*) filter (where has_sales) * 100e0 / count(*) from signals
  union all select 'sentiment', count(*) filter (where has_review_sentiment) * 100e0 / count(*) from signals)"""),
    "confidence_histogram": _histogram("signals", "data_confidence_score", 50),
    "confidence_histogram_40": _histogram("signals", "data_confidence_score", 40),
    "popularity_histogram": _histogram("scored", "popularity_score", 50),
    "popularity_confidence_bins": _with("scored", """
select cast(least(floor((popularity_score - lo) / (hi - lo) * 20), 19) as int) as popularity_bin,
  cast(least(floor(data_confidence_score * 20 / 100e0), 19) as int) as confidence_bin, count(*) as item_count
from scored cross join (select min(popularity_score) as lo, max(popularity_score) as hi from scored)
group by 1, 2"""),
    "segment_coverage": _with("scored recs", """
select case when data_confidence_score < 0 then 'unassigned' when data_confidence_score < 30 then 'low'
    when data_confidence_score < 60 then 'medium' when data_confidence_score < 80 then 'high'
    when data_confidence_score < 100 then 'very high' else 'unassigned' end as segment,
  count(*) as total, count(*) filter (where item_id in (select item_id from recs)) as in_top,
  round(count(*) filter (where item_id in (select item_id from recs)) / cast(count(*) as double), 9) as proportion
from scored group by 1"""),

    # Features
    "valid_item_tags": _with(
        "item_tags tags",
        "select item_id, tag_id from item_tags where tag_id in (select tag_id from tags)"),
    "feature_matrix": _with("features", f"select {_FEATURE_COLUMNS} from features"),
    "feature_matrix_wide": _with("scored bin", f"""
select s.item_id, {', '.join(f'coalesce(b."{n}", 0) as "{n}"' for n in _TAGS + _PLATFORMS)}, s.release_year,
  {_rounded('log_sales')}, s.total_review_count, {_rounded('popularity_score', 'richness_score')}
from scored s left join (select item_id, {_flags('tag', _TAGS)}, {_flags('platform', _PLATFORMS)}
  from bin group by item_id) b on s.item_id = b.item_id"""),
    "tag_onehot": _with("bin", f"select item_id, {_flags('tag', _TAGS)} from bin where kind = 'tag' group by item_id"),
    "platform_onehot": _with("bin", f"select item_id, {_flags('platform', _PLATFORMS)} from bin where kind = 'platform' group by item_id"),
    "top_tags": _with("bin", """
select feature, count(*) as item_count from bin where kind = 'tag' group by feature
order by item_count desc, feature limit 20"""),
    "feature_prefix_filter": _with("bin", """
select kind, feature, count(*) as item_count from bin
where starts_with(feature, 'NATION_1') or starts_with(feature, 're') or starts_with(feature, 's')
group by kind, feature"""),
    "feature_kind_counts": _with("bin", """
select kind, count(distinct feature) as feature_count from bin group by kind
union all select 'numeric', 19"""),
    "popularity_score": _with("scored", f"select item_id, {_rounded('popularity_score')} from scored"),
    "richness_score": _with("scored", f"select item_id, {_rounded('richness_score')} from scored"),
    "feature_cooccurrence": _with("bin", """
select a.kind || ':' || a.feature as feature_a, b.kind || ':' || b.feature as feature_b, count(*) as item_count
from bin a join bin b on a.item_id = b.item_id group by 1, 2"""),
    "svd_embedding": _with("items n_features bin", """
select i.item_id, (select cast(count(distinct kind || feature) as int) from bin) as dimensions,
  round(coalesce(n.n, 0e0), 6) as squared_norm
from items i left join n_features n on i.item_id = n.item_id"""),
    "svd_variance_total": _with("items bin", """
select count(*) as n_components, round(sum(p * (1 - p)), 6) as variance, 1e0 as explained_ratio
from (select kind, feature, count(*) / (select cast(count(*) as double) from items) as p from bin group by 1, 2)"""),

    "svd_truncated": _with("bin", """
select 16 as n_components, true as are_eigenvectors, true as converged, count(*) as entries, true as at_most_the_matrix
from bin"""),

    # Similarity and recommendation
    "pair_similarity": """
select a.vec_id as item_a, b.vec_id as item_b, round(list_cosine_similarity(
  cast(a.embedding as double[]), cast(b.embedding as double[])), 9) as similarity
from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
    "similar_items": _with("items cosines", """
select item_id, cast(rank as int) as rank, similar_id, similarity from (
  select a.item_id, b.item_id as similar_id, round(coalesce(c.sim, 0e0), 9) as similarity,
    row_number() over (partition by a.item_id order by round(coalesce(c.sim, 0e0), 9) desc, b.item_id) as rank
  from items a join items b on a.item_id <> b.item_id
  left join cosines c on c.item_a = a.item_id and c.item_b = b.item_id) where rank <= 20"""),
    "similar_items_lsh": """
select count(*) * least(20, count(*) - 1) as n_rows, true as recall_at_least_95, true as scored_at_most_a_tenth
from part""",
    "liked_profile_scores": _with("user_exclusions user_likes taste_cos items", """
select e.user_id, e.item_id, round(coalesce(t.content, 0e0), 9) as content_score
from user_exclusions e left join taste_cos t on t.user_id = e.user_id and t.item_id = e.item_id
where e.user_id in (select user_id from user_likes) and e.item_id in (select item_id from items)"""),
    "recommend_hybrid": _with("hybrid_scores user_exclusions", f"""
select user_id, {_REC_COLUMNS} from (select h.*, row_number() over (partition by user_id
    order by final_score desc, item_id) as rank
  from hybrid_scores h anti join user_exclusions x on x.user_id = h.user_id and x.item_id = h.item_id)
where rank <= 20"""),
    "recommend_cold_start": _with("scored user_exclusions", _COLD.format(
        users="(select c_custkey as user_id from customer)",
        anti=_ANTI, k=20)),
    "recommend_users": _with("scored user_likes hybrid", _COLD.format(
        users="(select c_custkey as user_id from customer where c_custkey not in (select user_id from user_likes))",
        anti="", k=5) + f"\nunion all select user_id, {_REC_COLUMNS} from hybrid where rank <= 5"),
    "recommend_profile": _with("recs", f"select profile, {_REC_COLUMNS} from recs"),
    "weights_top1": _with("grid scored taste_cos user_likes", """
select setting, user_id, item_id, final_score from (
  select *, row_number() over (partition by setting, user_id order by final_score desc, item_id) as rank from (
    select g.setting, u.user_id, s.item_id, round(g.alpha * coalesce(t.content, 0e0) + g.beta * s.popularity_score
      - (100e0 - s.data_confidence_score) / 100e0 * g.gamma, 9) as final_score
    from (select * from grid where setting < 6) g cross join (select distinct user_id from user_likes) u cross join scored s
    left join taste_cos t on t.user_id = u.user_id and t.item_id = s.item_id
    anti join user_likes l on l.user_id = u.user_id and l.item_id = s.item_id)) where rank = 1"""),
    "mmr_rerank": _with("hybrid cosines", """
, lists as (select user_id, rank as place, item_id, final_score from hybrid where rank <= 10),
first as (select user_id, item_id, final_score from lists where place = 1),
second as (select * from (
  select l.user_id, l.item_id, l.final_score, row_number() over (partition by l.user_id
    order by round(0.5e0 * l.final_score - 0.5e0 * coalesce(c.sim, 0e0), 12) desc, l.place) as n
  from lists l join first f on f.user_id = l.user_id and f.item_id <> l.item_id
  left join cosines c on c.item_a = l.item_id and c.item_b = f.item_id) where n = 1),
third as (select * from (
  select l.user_id, l.item_id, l.final_score, row_number() over (partition by l.user_id
    order by round(0.5e0 * l.final_score - 0.5e0 * greatest(coalesce(c.sim, 0e0), coalesce(d.sim, 0e0)), 12) desc, l.place) as n
  from lists l join first f on f.user_id = l.user_id and f.item_id <> l.item_id
  join second s on s.user_id = l.user_id and s.item_id <> l.item_id
  left join cosines c on c.item_a = l.item_id and c.item_b = f.item_id
  left join cosines d on d.item_a = l.item_id and d.item_b = s.item_id) where n = 1)
select user_id, 1 as rank, item_id, final_score from first
union all select user_id, 2, item_id, final_score from second
union all select user_id, 3, item_id, final_score from third""".strip()),
    "search_title": _with("scored", """
select item_id, title, round(popularity_score, 9) as popularity_score, data_confidence_score
from scored where contains(lower(title), 'ring') order by round(popularity_score, 9) desc, item_id limit 10"""),
    "search_title_indexed": _with("scored", """
select item_id, title, round(popularity_score, 9) as popularity_score, data_confidence_score
from scored where contains(lower(title), 'ring') order by round(popularity_score, 9) desc, item_id limit 10"""),
    "search_tags_in_titles": _with("scored tags", """
select tag_id, cast(rank as int) as rank, item_id, popularity_score from (
  select t.tag_id, s.item_id, round(s.popularity_score, 9) as popularity_score,
    row_number() over (partition by t.tag_id order by round(s.popularity_score, 9) desc, s.item_id) as rank
  from tags t join scored s on contains(lower(s.title), lower(t.tag_id))) where rank <= 10"""),
    "title_lookup": _with("items", "select title, min(item_id) as item_id from items group by title"),
    "score_progress": _with("hybrid", """
select user_id, cast(rank as int) as rank, item_id, round(least(final_score / max(final_score) over (partition by user_id), 1e0), 9) as progress
from hybrid where rank <= 5"""),

    # Learning to rank
    "rank_labels": _with("scored", """
select item_id, cast(floor(4 * ((popularity_score - lo) / (hi - lo))) as int) as label
from scored cross join (select min(popularity_score) as lo, max(popularity_score) as hi from scored)"""),
    "query_groups": _with("items item_platforms", """
select i.item_id, coalesce(min(p.platform_id), 'none') as query_group
from items i left join item_platforms p on i.item_id = p.item_id group by i.item_id"""),
    "group_split": _with("items item_platforms", """
, sizes as (select query_group, count(*) as group_size from (
  select i.item_id, coalesce(min(p.platform_id), 'none') as query_group
  from items i left join item_platforms p on i.item_id = p.item_id group by i.item_id) group by query_group)
select query_group, group_size, case when sum(group_size) over (order by query_group)
  <= floor((select count(*) from items) * 0.8e0) then 'train' else 'validation' end as side from sizes""".strip()),
    "grouped_ndcg": _with("scored item_platforms ks", (""", labelled as (
  select s.item_id, round(s.richness_score, 9) as score, cast(floor(4 * ((s.popularity_score - e.lo) / (e.hi - e.lo))) as int) as label,
    coalesce(p.g, 'none') as query_group
  from scored s cross join (select min(popularity_score) as lo, max(popularity_score) as hi from scored) e
  left join (select item_id, min(platform_id) as g from item_platforms group by item_id) p on p.item_id = s.item_id),"""
        + _grouped_dcg("labelled", "score", "got") + "," + _grouped_dcg("labelled", "label", "best") + """
select g.k, round(avg(case when b.dcg > 0 then g.dcg / b.dcg else 0e0 end), 9) as ndcg, count(*) as n_groups
from got g join best b on b.query_group = g.query_group and b.k = g.k
where g.query_group in (select query_group from labelled group by query_group having count(*) > 1)
group by g.k""")),

    # Offline evaluation
    "profile_relevant": _with("relevant", "select profile, item_id from relevant"),
    "profile_counts": _with("recs relevant", """
select p.profile, (select count(*) from relevant r where r.profile = p.profile) as n_relevant,
  (select count(*) from recs r where r.profile = p.profile) as n_recommended
from (select distinct profile from recs) p"""),
    "precision_at_k": _with("list_metrics", f"select profile, {_rounded('precision')} from list_metrics where setting = 1 and k = 5"),
    "recall_at_k": _with("list_metrics", f"select profile, {_rounded('recall')} from list_metrics where setting = 1 and k = 5"),
    "ndcg_at_k": _with("list_metrics", f"select profile, {_rounded('ndcg')} from list_metrics where setting = 1 and k = 10"),
    "map_at_k": _with("list_metrics", "select round(avg(average_precision), 9) as map from list_metrics where setting = 1 and k = 20"),
    "hit_rate_at_k": _with("list_metrics", "select round(avg(hit), 9) as hit_rate from list_metrics where setting = 1 and k = 20"),
    "user_list_metrics": _with("scored user_likes user_exclusions", """
, lists as (select user_id, rank, item_id from (""".strip() + _COLD.format(
        users="(select distinct user_id from user_likes)", anti=_ANTI, k=20) + """)),
marked as (select l.user_id, l.rank, case when v.item_id is null then 0 else 1 end as hit,
    sum(case when v.item_id is null then 0 else 1 end) over (partition by l.user_id order by l.rank) as run
  from lists l left join user_likes v on v.user_id = l.user_id and v.item_id = l.item_id),
sizes as (select user_id, count(*) as n from user_likes group by user_id)
select m.user_id, k.k, round(sum(hit) / cast(k.k as double), 9) as precision, round(sum(hit) / cast(s.n as double), 9) as recall,
  round(sum(hit / log2(rank + 1e0)) / list_sum(list_transform(range(1, least(s.n, k.k) + 1), lambda i: 1e0 / log2(i + 1e0))), 9) as ndcg,
  round(sum(hit * run / cast(rank as double)) / least(s.n, k.k), 9) as average_precision, max(hit) as hit
from marked m join (values (1), (5), (20)) k(k) on m.rank <= k.k join sizes s on s.user_id = m.user_id
group by m.user_id, k.k, s.n"""),
    "holdout_metrics": _held("hybrid user_likes", _HELD_METRICS.format(lists="hybrid") + """
select k, count(*) as n_lists, round(avg(precision), 9) as precision, round(avg(recall), 9) as recall, round(avg(ndcg), 9) as ndcg,
  round(avg(average_precision), 9) as average_precision, round(avg(hit), 9) as hit_rate from per_user group by k"""),
    "ab_user_variants": _held("hybrid user_likes grid", """
, lists as (select g.setting, h.user_id, h.item_id, row_number() over (partition by g.setting, h.user_id order by
    round(g.alpha * h.content_score + g.beta * h.popularity_score - g.gamma * (100e0 - h.data_confidence_score) / 100e0, 9) desc, h.item_id) as rank
  from hybrid_scores h cross join (values (1, 0.5e0, 0.4e0, 0.1e0), (2, 0.7e0, 0.2e0, 0.1e0)) g(setting, alpha, beta, gamma)
  qualify rank <= 20)""" + _HELD_METRICS.format(lists="lists") + """
, pairs as (select a.user_id, round(a.ndcg, 12) as a, round(b.ndcg, 12) as b from per_user a
  join per_user b on a.user_id = b.user_id and a.k = 20 and b.k = 20 and a.setting = 1 and b.setting = 2)
select round(avg(a), 9) as mean_a, round(stddev_pop(a), 9) as std_a, round(avg(b), 9) as mean_b, round(stddev_pop(b), 9) as std_b,
  round(avg(b - a), 9) as lift, count(*) filter (where a > b) as wins_a, count(*) filter (where b > a) as wins_b,
  count(*) filter (where a = b) as ties, count(*) as n_units,
  round(case when avg(a) > 0 then avg(b - a) / avg(a) * 100 else 0e0 end, 9) as lift_pct from pairs"""),
    "rank_model_lists": """
select count(*) as n_users, 20 * count(*) as n_rows, true as descending, 0 as n_liked from customer""",
    "ranker_comparison": """
select * from (values ('rank model', true), ('popularity', true)) v(ranker, above_constant)""",
    "table_summary": _with("gaps scored", """
select 'quality_gaps' as table_name, count(*) as row_count from gaps where missing_issues <> ''
union all select 'low_confidence_priorities', count(*) from scored where data_confidence_score < 30"""),
    "catalog_coverage": _with("recs items", """
select profile, count(distinct item_id) as n_items, round(count(distinct item_id) / (select cast(count(*) as double) from items), 9) as coverage
from recs group by profile
union all select 'combined', count(distinct item_id), round(count(distinct item_id) / (select cast(count(*) as double) from items), 9) from recs"""),
    "novelty": _with("recs", """
select profile, round(avg(-log2(popularity_score)) filter (where popularity_score > 0), 9) as novelty from recs group by profile
union all select 'combined', round(avg(-log2(popularity_score)) filter (where popularity_score > 0), 9) from recs"""),
    "intra_list_similarity": _with("recs cosines", """
select a.profile, cast(20 as bigint) as n_known, round(avg(coalesce(c.sim, 0e0)), 9) as similarity
from recs a join recs b on a.profile = b.profile and a.rank < b.rank
left join cosines c on c.item_a = a.item_id and c.item_b = b.item_id group by a.profile"""),
    "diversity": _with("recs cosines", """
, pairs as (select a.profile, b.rank, 1 - coalesce(c.sim, 0e0) as d
  from recs a join recs b on a.profile = b.profile and a.rank < b.rank
  left join cosines c on c.item_a = a.item_id and c.item_b = b.item_id)
select 'full list' as scope, round(avg(d), 9) as diversity from (select profile, avg(d) as d from pairs group by profile)
union all select 'first 5', round(avg(d), 9) from (select profile, avg(d) as d from pairs where rank <= 5 group by profile)""".strip()),
    "evaluation_table": _with("evaluation", "select metric, k, round(value, 9) as value from evaluation where setting = 1"),

    # Experiments
    "grid_search": _with("grid_result", f"""
select setting, alpha, beta, gamma, {_rounded('precision_at_5', 'ndcg_at_5', 'map_at_20', 'coverage', 'novelty')} from grid_result"""),
    "experiment_runs": _with("grid_result", "\nunion all ".join(
        f"select setting as run, '{kind}' as kind, '{name}' as name, round({name}, 9) as value from grid_result"
        for kind, name in (("param", "alpha"), ("param", "beta"), ("param", "gamma"),
                           ("metric", "precision_at_5"), ("metric", "ndcg_at_5"),
                           ("metric", "map_at_20"), ("metric", "coverage"), ("metric", "novelty")))),
    "ab_summary": _with("ab_units", """
select round(avg(metric_a), 9) as mean_a, round(stddev_pop(metric_a), 9) as std_a, round(avg(metric_b), 9) as mean_b,
  round(stddev_pop(metric_b), 9) as std_b, round(avg(metric_b - metric_a), 9) as lift,
  count(*) filter (where metric_a > metric_b) as wins_a, count(*) filter (where metric_b > metric_a) as wins_b,
  count(*) filter (where metric_a = metric_b) as ties, count(*) as n_units,
  round(case when avg(metric_a) > 0 then avg(metric_b - metric_a) / avg(metric_a) * 100 else 0e0 end, 9) as lift_pct
from ab_units"""),
    "ab_ztest": _with("ab_units", f"""
, stats as (select avg(metric_b - metric_a) as lift, stddev_pop(metric_b - metric_a) / sqrt(count(*)) as standard_error from ab_units),
tested as (select *, case when standard_error > 0 then lift / standard_error else 0e0 end as z from stats),
scaled as (select *, abs(z) / 1.4142135623730951e0 as x, 1e0 / (1e0 + 0.3275911e0 * (abs(z) / 1.4142135623730951e0)) as t from tested),
done as (select lift, standard_error, z, 2 * (1 - 0.5e0 * (1e0 + {_ERF})) as p_value from scaled)
select round(lift, 9) as lift, round(standard_error, 9) as standard_error, round(z, 9) as z, round(p_value, 9) as p_value,
  p_value < 0.05 as significant from done""".strip()),
    "ab_bootstrap_ci": _with("ab_units", """
, steps as (select k, cast(floor(sum(exp(-1) / factorial(cast(k as int))) over (order by k) * 4294967296) as bigint) as step
  from (select unnest(range(12)) as k)),
hashes as (select metric_b - metric_a as lift, blk.range as block, md5('42:' || unit_id || ':' || blk.range) as h
  from ab_units cross join range(2500) blk),
draws as (select block * 4 + i as rep, lift, cast('0x' || substr(h, 8 * i + 1, 8) as bigint) as draw
  from hashes cross join (select cast(range as int) as i from range(4))),
weights as (select rep, lift, list_sum(list_transform((select list(step) from steps), lambda s: cast(draw >= s as int))) as w from draws),
means as (select rep, sum(w * lift) / nullif(sum(w), 0) as m from weights group by rep)
select round(quantile_cont(m, 0.025), 9) as ci_low, round(quantile_cont(m, 0.975), 9) as ci_high,
  (select count(*) from ab_units) as n_units from means""".strip()),
    "ab_variants": _with("list_metrics", """
select round(avg(a.ndcg), 9) as mean_a, round(stddev_pop(a.ndcg), 9) as std_a, round(avg(b.ndcg), 9) as mean_b,
  round(stddev_pop(b.ndcg), 9) as std_b, round(avg(b.ndcg - a.ndcg), 9) as lift,
  count(*) filter (where a.ndcg > b.ndcg) as wins_a, count(*) filter (where b.ndcg > a.ndcg) as wins_b,
  count(*) filter (where a.ndcg = b.ndcg) as ties, count(*) as n_units,
  round(case when avg(a.ndcg) > 0 then avg(b.ndcg - a.ndcg) / avg(a.ndcg) * 100 else 0e0 end, 9) as lift_pct
from (select profile, round(ndcg, 12) as ndcg from list_metrics where k = 10 and setting = 1) a
join (select profile, round(ndcg, 12) as ndcg from list_metrics where k = 10 and setting = 3) b on a.profile = b.profile"""),

    # Explanation
    "explain_rules": _with("hybrid", f"""
select user_id, cast(rank as int) as rank, item_id, {_RULE} as explanation from (select *, {_RULE_PARTS} as t from hybrid where rank <= 5)"""),
    "template_text": _with("hybrid", f"select user_id, cast(rank as int) as rank, item_id, {_TEMPLATE} as explanation from hybrid where rank <= 5"),
    "item_details": _with("items item_platforms platforms", """
select i.item_id, i.title, i.release_year, i.category_id, coalesce(p.names, '') as platforms
from items i left join (select ip.item_id, string_agg(p.name, ', ' order by p.name) as names
  from item_platforms ip join platforms p on ip.platform_id = p.platform_id group by ip.item_id) p on p.item_id = i.item_id"""),
    "explanation_prompts": _with("hybrid items item_platforms platforms", f"""
select h.user_id, cast(h.rank as int) as rank, h.item_id, '[recommendation]
item=' || i.item_id || '
title=' || i.title || '
released=' || coalesce(cast(i.release_year as varchar), '?') || '
category=' || coalesce(i.category_id, '?') || '
on=' || coalesce(p.names, '?') || '
final_score=' || {_two('h.final_score')} || '
content_score=' || {_two('h.content_score')} || '
popularity_score=' || {_two('h.popularity_score')} || '
data_confidence=' || h.data_confidence_score || '
[task]
Name what in these data speaks for the item. Use no other facts.' as prompt
from hybrid h join items i on i.item_id = h.item_id left join (
  select ip.item_id, string_agg(p.name, '|' order by p.name) as names
  from item_platforms ip join platforms p on ip.platform_id = p.platform_id group by ip.item_id) p on p.item_id = h.item_id
where h.rank <= 5"""),
    "explanation_compare": _with("hybrid", f"""
select user_id, cast(rank as int) as rank, item_id, cast(length(rule) as int) as a_chars, cast(length(tpl) as int) as b_chars, length(tpl) > length(rule) as b_is_longer
from (select user_id, rank, item_id, {_RULE} as rule, {_TEMPLATE} as tpl
  from (select *, {_RULE_PARTS} as t from hybrid where rank <= 5))"""),

    # Diagnostics
    "quality_gaps": _with("gaps", """
select item_id, title, missing_issues, data_confidence_score, round(popularity_score, 9) as popularity_score
from gaps where missing_issues <> ''"""),
    "diag_duplicate_groups": _with("dup_groups", "select group_key, suggested_review, status, candidate_count from dup_groups"),
    "diag_external_matches": _with("external_matches", """
select item_id, source, source_title, confidence_score, matched_by from external_matches
where confidence_score >= 70 order by confidence_score desc, match_id limit 5000"""),
    "low_confidence_priorities": _with("scored", """
select item_id, title, data_confidence_score, round(popularity_score, 9) as popularity_score
from scored where data_confidence_score < 30"""),
    "key_metrics": _with("grid_result items bin", """
, best as (select * from grid_result order by round(ndcg_at_5, 9) desc, setting limit 1)
select 'alpha_best' as metric, alpha as value, 'alpha of the row with the highest NDCG@5' as description from best
union all select 'beta_best', beta, 'beta of the row with the highest NDCG@5' from best
union all select 'gamma_best', gamma, 'gamma of the row with the highest NDCG@5' from best
union all select 'ndcg_at_5_best', round(ndcg_at_5, 9), 'highest NDCG@5 among all settings tried' from best
union all select 'precision_at_5_best', round(precision_at_5, 9), 'Precision@5 in the row with the highest NDCG@5' from best
union all select 'total_items_in_catalog', cast(count(*) as double), 'number of scored item rows' from items
union all select 'feature_dimensions', cast(count(distinct kind || feature) as double), 'number of columns that the embedding was fitted to' from bin""".strip()),
    "snapshot_diff": _with("gaps scored", """
, counted as (
  select count(*) filter (where missing_issues like '%no_category%') as c, count(*) filter (where missing_issues like '%no_category%'
      and item_id % 10 <> 0) as c2, count(*) filter (where missing_issues like '%no_cover%') as v,
    count(*) filter (where missing_issues like '%no_year%') as y, count(*) filter (where missing_issues like '%no_tags%') as t,
    count(*) filter (where missing_issues like '%no_platforms%') as p from gaps),
low as (select count(*) as a, count(*) filter (where item_id % 7 <> 0) as b from scored where data_confidence_score < 30)
select 'no_category' as measure, c as before, c2 as after, c - c2 as improvement from counted
union all select 'no_cover', v, v, 0 from counted
union all select 'no_year', y, y, 0 from counted
union all select 'no_tags', t, t, 0 from counted
union all select 'no_platforms', p, p, 0 from counted
union all select 'low_confidence_priorities', a, b, a - b from low""".strip()),
}
