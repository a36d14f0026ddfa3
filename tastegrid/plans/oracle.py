"""DuckDB SQL that answers the same questions over the same parquet tables.

Shared pieces are common table expressions; ``sql(name)`` puts in front of a query the ones it
mentions, in dependency order.
"""

from __future__ import annotations

import re

from tastegrid.plans.catalog import (
    AS_OF, GENRE, HEAT_MAP, HELD_OUT, K, KS, LIKED, MIN_VOTES, SIMILAR, TARGET_TITLE, USER,
)

# The genres of the test data.
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BRANDS = [f"Brand#{n}" for n in range(1, 26)]


def initcap(text: str) -> str:
    word = "concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))"
    return f"array_to_string([{word} for w in string_split({text}, ' ')], ' ')"


def literal_list(text: str) -> str:
    return f"replace({text}, '~', chr(39))"


CTES: dict[str, str] = {}

CTES["rating_events"] = """
select cast(o_custkey as bigint) as "userId", cast(l_partkey as bigint) as "movieId",
       cast(ceil(l_quantity / 5.0) as double) / 2 as rating, l_shipdate as ts, l_orderkey as ok, l_linenumber as ln,
       o_orderpriority, l_discount, l_tax
from lineitem join orders on l_orderkey = o_orderkey"""

CTES["ratings"] = """
select "userId", "movieId", rating, ts, ok, ln from (
  select *, row_number() over (partition by "userId", "movieId" order by ts desc, ok desc, ln desc) rn
  from rating_events) z where rn = 1"""

CTES["movies_raw"] = f"""
select cast(p_partkey as bigint) as id, concat('tt', lpad(cast(p_partkey * 7 + 1 as varchar), 7, '0')) as imdb_id,
  p_name as title, d.text as overview,
  case when p_size % 2 = 0 then null else p_brand end as tagline,
  case when p_size > 40 then null else 'Released' end as status, d.lang as original_language,
  case when p_partkey % 5 = 0 then 'True' when p_partkey % 5 = 1 then null else 'False' end as adult,
  case when p_type = 'PROMO' then 'True' when p_type = 'SMALL' then null else 'False' end as video,
  concat('$', cast(cast(round(p_retailprice * 100) as bigint) as varchar)) as budget, v.revenue,
  case when p_size < 5 then null else cast(p_size * 3 as double) end as runtime,
  case when p_partkey % 13 = 0 then '' else concat('pop ', cast(p_size as varchar), '.5') end as popularity,
  coalesce(v.vote_count, 0) as vote_count, coalesce(v.vote_average, 0.0) as vote_average, v.release_date,
  case when p_partkey % 7 = 0 then '[]' else {literal_list(
      "concat('[{~id~: ', cast(p_size as varchar), ', ~name~: ~', p_type, '~}, {~id~: 100, ~name~: ~', p_brand, '~}]')"
  )} end as genres,
  {literal_list("concat('[{~name~: ~', p_brand, '~, ~id~: ', cast(p_size as varchar), '}]')")} as production_companies,
  {literal_list("concat('[{~iso_3166_1~: ~', substr(p_type, 1, 2), '~, ~name~: None}]')")} as production_countries,
  case when d.lang is null then '[]' else {literal_list(
      "concat('[{~iso_639_1~: ~', d.lang, '~, ~name~: ~', upper(d.lang), '~}]')")} end as spoken_languages,
  p_size, p_type, p_brand, d.lang
from part
left join (select "movieId", cast(min(ts) as date) release_date, count(*) vote_count,
                  round(avg(rating) * 2, 4) vote_average, round(sum(rating), 2) revenue
           from ratings group by "movieId") v on v."movieId" = p_partkey
left join documents d on d.doc_id = p_partkey"""

CTES["scrubbed"] = """
select * replace (
  try_cast(regexp_replace(budget, '[^0-9]', '', 'g') as double) as budget,
  try_cast(regexp_replace(popularity, '[^0-9.]', '', 'g') as double) as popularity)
from movies_raw"""

CTES["clean"] = """
select id, imdb_id, coalesce(title, '') title, coalesce(budget, 0) budget, coalesce(revenue, 0) revenue,
  coalesce(runtime, 0) runtime, popularity, vote_count, vote_average, coalesce(status, 'Unknown') status,
  coalesce(original_language, 'Unknown') original_language, coalesce(adult = 'True', false) adult,
  coalesce(video = 'True', false) video, release_date, cast(year(release_date) as int) release_year,
  coalesce(tagline, '') tagline, coalesce(overview, '') overview
from scrubbed where id is not null and release_date is not null"""

CTES["movies"] = """
select id as "movieId", title, vote_count, vote_average, cast(year(release_date) as int) release_year,
  case when id % 7 = 0 then null else p_size end as genre_id, case when id % 7 = 0 then null else p_type end genre_name
from movies_raw"""

CTES["genre_rows_all"] = """
select id, p_size as genre_id, p_type as genre_name from movies_raw where id % 7 <> 0
union all select id, 100, p_brand from movies_raw where id % 7 <> 0"""

CTES["labelled_movies"] = """
select m."movieId", title, genre_id, m.genre_name, release_year, genres_indexed from movies m left join (
  select genre_name, cast(row_number() over (order by count(*) desc, genre_name) - 1 as int) genres_indexed
  from movies where genre_name is not null group by 1) i on i.genre_name = m.genre_name"""

CTES["cast_members"] = f"""
select cast(l_partkey as bigint) movie_id, {initcap("lower(s_name)")} cast_name, cast(null as varchar) "character",
  cast(l_suppkey % 3 as int) cast_gender, cast(min(l_orderkey) as bigint) cast_order
from lineitem join supplier on l_suppkey = s_suppkey group by l_partkey, l_suppkey, s_name"""

CTES["crew_members"] = f"""
select cast(l_partkey as bigint) movie_id, {initcap("lower(c_name)")} crew_name,
  case when o_orderpriority = '1-URGENT' then 'Director' else 'Crew' end job,
  min(c_mktsegment) department, cast(min(c_custkey % 3) as int) crew_gender
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1, 2, 3"""

CTES["cast_summary"] = """
select movie_id, count(*) cast_count, arg_min(cast_name, (cast_order, cast_name)) lead_actor,
  count(*) filter (cast_gender = 1) female_cast_count, count(*) filter (cast_gender = 2) male_cast_count
from cast_members group by 1"""

CTES["crew_summary"] = """
select movie_id, cast(sum(n) as bigint) crew_count, arg_min(department, (-n, department)) most_common_department,
  cast(sum(f) as bigint) female_crew_count, cast(sum(m) as bigint) male_crew_count
from (select movie_id, department, count(*) n, count(*) filter (crew_gender = 1) f, count(*) filter (crew_gender = 2) m
      from crew_members group by 1, 2) z group by 1"""

CTES["keyword_texts"] = f"""
select cast(p_partkey as bigint) movie_id, p_name, p_brand, {literal_list(
    "concat('[~', replace(p_name, ' ', '~, ~'), '~, ~', p_brand, '~]')")} keywords from part"""

CTES["keyword_set"] = f"""
select distinct movie_id, {initcap("k")} keyword_name from (
  select movie_id, unnest(string_split(concat(p_name, ' ', p_brand), ' ')) k from keyword_texts) z where k <> ''"""

CTES["keyword_csv"] = """
select movie_id, array_to_string(list_sort(list_distinct(string_split(concat(p_name, ' ', p_brand), ' '))), ',') keyword_names
from keyword_texts"""

CTES["keyword_used"] = "select movie_id, unnest(string_split(keyword_names, ',')) k from keyword_csv"

CTES["links_full"] = """
select cast(p_partkey as bigint) "movieId", cast(case when p_partkey % 50 = 0 then 0 else p_partkey * 7 + 1 end as bigint) "imdbId",
  case when p_partkey % 11 = 0 then null else cast(p_partkey + 100000 as bigint) end "tmdbId" from part"""

CTES["links_small"] = """
select cast(p_partkey as bigint) "movieId", cast(case when p_partkey % 50 = 0 then 0 else p_partkey * 7 + 1 end as bigint) "imdbId",
  case when p_partkey % 4 = 0 then null else cast(p_partkey + 200000 as bigint) end "tmdbId" from part where p_size > 25"""

CTES["movie_text"] = """
select "movieId", m.title, concat_ws(' ', m.genre_name, r.overview, c.lead_actor, replace(k.keyword_names, ',', ' '))
  combined_features
from movies m join movies_raw r on r.id = "movieId" left join cast_summary c on c.movie_id = "movieId"
left join keyword_csv k on k.movie_id = "movieId" """


def weights(name: str, key: str, source: str, text: str) -> None:
    CTES[f"{name}_tf"] = rf"""
select {key}, term, count(*) tf from (
  select {key}, unnest(regexp_split_to_array(lower({text}), '\s')) term from {source}) z group by 1, 2"""
    CTES[f"{name}_w"] = f"""
select {key}, t.term, tf * ln(((select count(*) from {source}) + 1.0) / (df + 1.0)) tfidf
from {name}_tf t join (select term, count(*) df from {name}_tf group by 1) f on f.term = t.term"""
    CTES[f"{name}_norm"] = f"select {key}, sqrt(sum(tfidf * tfidf)) norm from {name}_w group by 1"


weights("doc", "doc_id", "documents", "text")
weights("movie", '"movieId"', "movie_text", "combined_features")

CTES["doc_knn"] = f"""
select doc_id, rank, neighbor_id, similarity from (
  select *, cast(row_number() over (partition by doc_id order by similarity desc, neighbor_id) as int) rank from (
    select a.doc_id, b.doc_id neighbor_id, round(coalesce(dot / nullif(a.norm * b.norm, 0), 0), 6) similarity
    from doc_norm a join doc_norm b on a.doc_id <> b.doc_id
    left join (select x.doc_id l, y.doc_id r, sum(x.tfidf * y.tfidf) dot from doc_w x join doc_w y on x.term = y.term
               group by 1, 2) s on l = a.doc_id and r = b.doc_id) p) z where rank <= {K}"""


def popular_unseen(name: str, source: str, n: int) -> None:
    CTES[f"{name}_order"] = f"""
select "movieId", count(*) score, row_number() over (order by count(*) desc, "movieId") pos from {source} group by 1"""
    CTES[name] = f"""
select "userId", rank, "movieId", score from (
  select u."userId", o."movieId", score, cast(row_number() over (partition by u."userId" order by pos) as int) rank
  from (select distinct "userId" from {source}) u cross join {name}_order o
  where not exists (select 1 from {source} s where s."userId" = u."userId" and s."movieId" = o."movieId")) z
where rank <= {n}"""


CTES["split_ratings"] = f"""
select *, case when row_number() over (partition by "userId" order by ts desc, ok desc, ln desc) <= {HELD_OUT}
  then 'test' else 'train' end split from ratings"""
CTES["training"] = "select * from split_ratings where split = 'train'"
CTES["truth"] = f"""select "userId", "movieId" from split_ratings where split = 'test' and rating >= {LIKED}"""
popular_unseen("recs", "ratings", K)
popular_unseen("trained_recs", "training", max(KS))

CTES["decayed"] = f"""
select *, rating * exp(-0.5 * ({AS_OF} - epoch(ts)) / 2592000.0) weighted_rating from ratings"""

CTES["same_genre_lists"] = f"""
select "movieId", rank, rec_id, title, genre_name, vote_average from (
  select a."movieId", b."movieId" rec_id, b.title, a.genre_name, b.vote_average,
    cast(row_number() over (partition by a."movieId" order by b.vote_average desc, b."movieId") as int) rank
  from movies a join movies b on a.genre_name = b.genre_name and a."movieId" <> b."movieId") z where rank <= {K}"""

CTES["marked"] = """
select r.*, case when t."userId" is null then 0 else 1 end hit,
  sum(case when t."userId" is null then 0 else 1 end) over (partition by r."userId" order by rank) so_far
from trained_recs r left join truth t on t."userId" = r."userId" and t."movieId" = r."movieId" """

CTES["user_metrics"] = """
select k, m."userId", count(*) n, sum(hit) hits, sum(hit * so_far / rank) gain, coalesce(max(n_relevant), 0) n_relevant
from marked m join (select unnest({ks}) k) ks on rank <= k
left join (select "userId", count(*) n_relevant from truth group by 1) t on t."userId" = m."userId" group by 1, 2
""".replace("{ks}", str(list(KS)))

CTES["curve"] = """
select k, avg(hits / least(n, k)) p, avg(case when n_relevant > 0 then hits / n_relevant end) r,
  avg(case when n_relevant > 0 then gain / least(n_relevant, k) end) map from user_metrics group by 1"""

CTES["diversity"] = """
select "userId", count(distinct coalesce(genre_name, 'Unknown')) genre_diversity
from recs left join genre_rows_all g on g.id = recs."movieId" group by 1"""

CTES["rec_means"] = """
select "movieId", avg(rating) avg_rating from ratings where "movieId" in (select "movieId" from recs) group by 1"""

CTES["hit_users"] = """
select h."userId", hits, n, n_relevant
from (select r."userId", count(*) hits from trained_recs r join truth t
      on t."userId" = r."userId" and t."movieId" = r."movieId" group by 1) h
join (select "userId", count(*) n from trained_recs group by 1) a on a."userId" = h."userId"
join (select "userId", count(*) n_relevant from truth group by 1) b on b."userId" = h."userId" """

CTES["heat_map_items"] = f"""
select "movieId", sum(rating) s, sum(rating * rating) ss from ratings where "movieId" in (
  select "movieId" from ratings group by 1 order by count(*) desc, "movieId" limit {HEAT_MAP}) group by 1"""

BODIES: dict[str, str] = {}

PROFILED = ["id", "imdb_id", "title", "overview", "tagline", "status", "original_language", "adult", "video", "budget",
            "revenue", "runtime", "popularity", "vote_count", "vote_average", "release_date", "genres",
            "production_companies", "production_countries", "spoken_languages"]
BODIES["profile_nulls"] = " union all ".join(
    f"select '{c}' column_name, count(*) n_rows, count(*) - count({c}) n_null, count(distinct {c}) n_distinct"
    " from movies_raw" for c in PROFILED)
BODIES["clean_numeric"] = "select id, budget, popularity, vote_count, vote_average from scrubbed"
BODIES["movies_clean"] = "select * from clean"
BODIES["ratings_clean"] = """
select "userId", "movieId", rating, cast(ts as date) rating_date, ok, ln from (
  select * replace (case when l_discount >= 0.1 then null when l_tax >= 0.08 then rating + 5 else rating end as rating)
  from rating_events) z where rating between 0 and 5"""
BODIES["ratings_union"] = """
select distinct "userId", "movieId", rating, cast(epoch(ts) as bigint) "timestamp" from rating_events"""
BODIES["ratings_dedup"] = """
select "userId", "movieId", rating, cast(epoch(ts) as bigint) "timestamp", ok, ln from ratings"""
BODIES["rating_dates"] = """
select "userId", "movieId", cast(ts as date) rating_date, cast(epoch(ts) as bigint) "timestamp" from ratings"""
BODIES["links_clean"] = """
select "movieId", lpad(cast("imdbId" as varchar), 7, '0') "imdbId", "tmdbId",
  cast(length(lpad(cast("imdbId" as varchar), 7, '0')) as int) "imdbId_length",
  cast(length(cast("tmdbId" as varchar)) as int) "tmdbId_length",
  1 "has_imdbId", cast("tmdbId" > 0 as int) "has_tmdbId",
  concat(lpad(cast("imdbId" as varchar), 7, '0'), '_', cast("tmdbId" as varchar)) combined_id
from (select "movieId", "imdbId", coalesce("tmdbId", -1) "tmdbId",
        row_number() over (partition by "movieId" order by src) rn
      from (select 0 src, * from links_small union all select 1, * from links_full) u) z
where rn = 1 and "imdbId" > 0 and "tmdbId" >= 0"""
BODIES["links_outer_merge"] = """
select * from (select coalesce(s."movieId", f."movieId") "movieId", coalesce(s."imdbId", f."imdbId") "imdbId",
  coalesce(s."tmdbId", f."tmdbId") "tmdbId"
from links_full f full join links_small s on s."movieId" = f."movieId" and s."imdbId" = f."imdbId") z
where "tmdbId" is not null"""
BODIES["links_outer_merge_sentinel"] = """
select * from (select coalesce(s."movieId", f."movieId") "movieId", coalesce(s."imdbId", f."imdbId") "imdbId",
  case when s."movieId" is not null then coalesce(s."tmdbId", -1) else coalesce(f."tmdbId", -1) end "tmdbId"
from links_full f full join links_small s on s."movieId" = f."movieId" and s."imdbId" = f."imdbId") z
where "tmdbId" <> -1"""
BODIES["keyword_rows"] = "select movie_id, keyword_name from keyword_set"
# Splitting the bracketed text as a plain list leaves brackets and inner quotes on the parts.
BODIES["keyword_rows_literal"] = f"""
select distinct movie_id, {initcap("k")} keyword_name from (
  select movie_id, trim(regexp_replace(part, concat('^[', chr(39), '"]|[', chr(39), '"]$'), '', 'g')) k from (
    select movie_id, unnest(string_split(keywords, ',')) part from keyword_texts) y) z where k <> ''"""
BODIES["keyword_lists"] = "select movie_id, keyword_names from keyword_csv"
BODIES["genre_rows"] = "select id, genre_id, genre_name from genre_rows_all"
BODIES["company_rows"] = "select id, p_size company_id, p_brand company_name from movies_raw"
BODIES["country_rows"] = """
select id, substr(p_type, 1, 2) country_iso, cast(null as varchar) country_name from movies_raw"""
BODIES["language_rows"] = """
select id, lang language_iso, upper(lang) language_name from movies_raw where lang is not null"""
BODIES["genre_multihot"] = "select id, " + ", ".join(
    f"""cast(id % 7 <> 0 and (p_type = '{g}' or p_brand = '{g}') as int) "{g}" """ for g in TYPES + BRANDS
) + " from movies_raw"
BODIES["log_features"] = """
select id, round(ln(1 + budget), 6) log_budget, round(ln(1 + revenue), 6) log_revenue from clean"""
BODIES["popularity_bins"] = """
select id, popularity, case when popularity <= low then 'low' when popularity <= high then 'medium' else 'high' end
  popularity_bin
from scrubbed, (select quantile_disc(popularity, 0.33) low, quantile_disc(popularity, 0.66) high from scrubbed) q"""
BODIES["text_lengths"] = """
select id, cast(length(overview) as int) overview_length, cast(length(tagline) as int) tagline_length from clean"""
BODIES["release_features"] = """
select id, cast(year(release_date) as int) release_year, cast(floor(year(release_date) / 10.0) * 10 as int) release_decade
from movies_raw"""
BODIES["weighted_rating"] = """
select id, round(vote_count / (vote_count + m) * vote_average + m / (m + vote_count) * 7.0, 6) weighted_rating
from movies_raw, (select avg(vote_count) m from movies_raw) a"""
BODIES["keyword_vectors"] = """
select movie_id, cast(count(*) as int) n_keywords, round(sum(ln(((select count(*) from keyword_csv) + 1.0) / (df + 1.0))), 6)
  total_weight
from keyword_used join (select k, count(*) df from keyword_used group by 1) f using (k) group by 1"""
BODIES["cast_rows"] = """select movie_id, cast_name, "character", cast_gender, cast_order from cast_members"""
BODIES["crew_rows"] = "select movie_id, crew_name, job, department, crew_gender from crew_members"
BODIES["cast_features"] = "select * from cast_summary"
BODIES["crew_features"] = "select * from crew_summary"
BODIES["top5_cast"] = """
select movie_id, string_agg(cast_name, '|' order by rn) cast_names from (
  select *, row_number() over (partition by movie_id order by cast_order, cast_name) rn from cast_members) z
where rn <= 5 group by 1"""
BODIES["director_per_movie"] = """
select d.movie_id, c.lead_actor, d.director
from (select distinct movie_id, crew_name director from crew_members where job = 'Director') d
left join cast_summary c on c.movie_id = d.movie_id"""
BODIES["movies_enriched"] = """
select m."movieId" id, title, genre_name, cast_count, lead_actor, female_cast_count, male_cast_count, crew_count,
  most_common_department, female_crew_count, male_crew_count, keyword_names
from movies m left join cast_summary c on c.movie_id = m."movieId" left join crew_summary w on w.movie_id = m."movieId"
left join keyword_csv k on k.movie_id = m."movieId" """
BODIES["combined_text"] = 'select "movieId", title, combined_features from movie_text'
BODIES["user_profile"] = """
select "userId", round(avg(rating), 6) user_avg_rating, count(rating) user_rating_count from ratings group by 1"""
BODIES["movie_profile"] = """
select "movieId", round(avg(rating), 6) movie_avg_rating, count(rating) movie_rating_count from ratings group by 1"""
BODIES["ratings_enriched"] = """
select "userId", "movieId", rating, cast(ts as date) rating_date,
  round(avg(rating) over (partition by "userId"), 6) user_avg_rating,
  count(*) over (partition by "userId") user_rating_count,
  round(avg(rating) over (partition by "movieId"), 6) movie_avg_rating,
  count(*) over (partition by "movieId") movie_rating_count from ratings"""
BODIES["mean_centered"] = """
select "userId", "movieId", round(m, 6) user_avg_rating, round(rating - m, 6) rating_norm
from (select *, avg(rating) over (partition by "userId") m from ratings) z"""
BODIES["user_item_mean"] = """
select "userId", "movieId", round(avg(rating), 6) rating from rating_events group by 1, 2"""
BODIES["time_decay"] = 'select "userId", "movieId", round(weighted_rating, 9) weighted_rating from decayed'
BODIES["decayed_popularity"] = """
select "movieId", round(sum(weighted_rating), 6) decayed_score from decayed group by 1"""
BODIES["decayed_popularity_merged"] = BODIES["decayed_popularity"]
BODIES["missing_movie_ids"] = """
select distinct "movieId" from ratings where "movieId" not in (select doc_id from documents where text is not null)"""
DEFAULTS = """coalesce(title, 'Unknown') title, coalesce(genre_id, -1) genre_id, coalesce(genre_name, 'Unknown') genre_name,
  coalesce(release_year, -1) release_year, coalesce(genres_indexed, -1) genres_indexed"""
BODIES["enriched_ratings"] = f"""
select "userId", r."movieId", rating, {DEFAULTS} from ratings r left join labelled_movies m on m."movieId" = r."movieId" """
BODIES["key_split"] = """
select "userId", "movieId", rating, case when ("userId" * 31 + "movieId" * 17) % 10 < 8 then 'train' else 'test' end split
from ratings"""
BODIES["holdout_last_n"] = 'select "userId", "movieId", rating, split from split_ratings'
BODIES["token_counts"] = "select doc_id, term, tf from doc_tf"
BODIES["tfidf_weights"] = "select doc_id, term, round(tfidf, 6) tfidf from doc_w"
BODIES["keyword_multihot"] = "select movie_id, keyword_name, cast(1 as double) \"value\" from keyword_set"
BODIES["keyword_tfidf"] = """
select movie_id, k.keyword_name, round(ln(((select count(distinct movie_id) from keyword_set) + 1.0) / (df + 1.0)), 6) tfidf
from keyword_set k join (select keyword_name, count(*) df from keyword_set group by 1) f on f.keyword_name = k.keyword_name"""
BODIES["string_index"] = """
select genre_name, count(*) label_count, row_number() over (order by count(*) desc, genre_name) - 1 genre_index
from genre_rows_all group by 1"""
CTES["to_target"] = f"""
select n."movieId", target, round(coalesce(dot / nullif(norm * (select norm from movie_norm where "movieId" = target), 0), 0), 6)
  similarity
from movie_norm n cross join (select min("movieId") target from movies where title = '{TARGET_TITLE}') t
left join (select a."movieId" l, b."movieId" r, sum(a.tfidf * b.tfidf) dot from movie_w a
           join movie_w b on a.term = b.term
           where b."movieId" = (select min("movieId") from movies where title = '{TARGET_TITLE}') group by 1, 2) s
  on l = n."movieId" """
CTES["near_target"] = f"""
select * from to_target where "movieId" <> target order by similarity desc, "movieId" limit {K}"""
BODIES["cosine_to_target"] = f"""
select "movieId", similarity from to_target order by similarity desc, "movieId" limit {K}"""
BODIES["similar_to_title"] = """
select n."movieId", title, similarity from near_target n join movies m on m."movieId" = n."movieId" """
BODIES["hybrid_for_user"] = f"""
select n."movieId", title, round(0.5 * similarity + 0.5 * coalesce(norm, 0), 7) score
from near_target n join movies m on m."movieId" = n."movieId"
left join (select "movieId" i, rating - avg(rating) over () norm from ratings where "userId" = {USER}) c
  on i = n."movieId"
where exists (select 1 from ratings where "userId" = {USER})"""
BODIES["knn_topk"] = "select doc_id, rank, neighbor_id, similarity from doc_knn"
BODIES["knn_dense_topk"] = f"""
select vec_id, rank, neighbor_id, similarity from (
  select *, cast(row_number() over (partition by vec_id order by similarity desc, neighbor_id) as int) rank from (
    select a.vec_id, b.vec_id neighbor_id, round(coalesce(list_dot_product(a.e, b.e)
      / nullif(sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)), 0), 0), 6) similarity
    from v a join v b on a.vec_id <> b.vec_id) p) z where rank <= {K}"""
CTES["v"] = "select vec_id, cast(embedding as double[]) e from embeddings"
CTES["doc_first"] = """
select doc_id, min(doc_id) over (partition by e) first_id from (
  select doc_id, list({'t': term, 'w': tfidf} order by term) e from doc_w group by doc_id) z"""
BODIES["document_copies"] = "select doc_id, first_id from doc_first"
BODIES["similar_documents"] = f"""
select doc_id, similar_id, similarity from (
  select x.doc_id, y.doc_id similar_id, round(sum(x.tfidf * y.tfidf) / (any_value(a.norm) * any_value(b.norm)), 6) similarity
  from doc_w x join doc_w y on x.term = y.term and x.doc_id < y.doc_id
  join doc_norm a on a.doc_id = x.doc_id join doc_norm b on b.doc_id = y.doc_id
  where x.doc_id in (select first_id from doc_first) and y.doc_id in (select first_id from doc_first)
  group by x.doc_id, y.doc_id) p where similarity >= {SIMILAR}"""
BODIES["hybrid_scores"] = f"""
select "userId", seed_id, rank, "movieId", score from (
  select *, cast(row_number() over (partition by "userId" order by score desc, "movieId") as int) rank from (
    select s."userId", seed_id, cast(neighbor_id as bigint) "movieId",
      round(0.5 * similarity + 0.5 * coalesce(norm, 0), 7) score
    from (select "userId", "movieId" seed_id from (
            select *, row_number() over (partition by "userId" order by rating desc, ts desc, ok desc, ln desc) rn
            from ratings where "movieId" in (select doc_id from documents)) y where rn = 1) s
    join doc_knn n on n.doc_id = seed_id
    left join (select "userId" u, "movieId" i, rating - avg(rating) over (partition by "userId") norm from ratings) c
      on u = s."userId" and i = neighbor_id) x) z where rank <= {K}"""
BODIES["same_genre"] = "select * from same_genre_lists"
BODIES["popular_unseen_topk"] = """select "userId", rank, "movieId", score from recs"""
BODIES["flatten_recs"] = """select "userId", "movieId", cast(score as double) rating from recs"""
BODIES["recs_with_metadata"] = f"""
select "userId", rank, r."movieId", score predicted_rating, {DEFAULTS}
from recs r left join labelled_movies m on m."movieId" = r."movieId" """
BODIES["filter_by_genre"] = f"""
select "userId", rank, r."movieId", genre_name from recs r join movies m on m."movieId" = r."movieId"
where contains(genre_name, '{GENRE}')"""
BODIES["filter_by_popularity"] = f"""
select "userId", rank, r."movieId", vote_count from recs r join movies m on m."movieId" = r."movieId"
where vote_count >= {MIN_VOTES}"""
BODIES["advanced_recs"] = f"""
select "userId", rank, r."movieId", title, genre_name, vote_count, decayed_score
from recs r join movies m on m."movieId" = r."movieId"
join (select "movieId", round(sum(weighted_rating), 6) decayed_score from decayed group by 1) d on d."movieId" = r."movieId"
where contains(genre_name, '{GENRE}') and vote_count >= {MIN_VOTES}"""
BODIES["explain_recs"] = """
select "movieId", rank, rec_id, concat(title, ': same genre (', genre_name, ') as the title you picked') explanation
from same_genre_lists"""
BODIES["hybrid_union"] = """
select "userId" list_for, 'collaborative' source, rank, "movieId" from recs
union all select "movieId", 'content', rank, rec_id from same_genre_lists"""
BODIES["rmse_baseline"] = """
select round(sqrt(avg((rating - p) * (rating - p))), 6) rmse from ratings r join (
  select "movieId", avg(rating) p from ratings where ("userId" * 31 + "movieId" * 17) % 10 < 8 group by 1) m
  on m."movieId" = r."movieId" where ("userId" * 31 + r."movieId" * 17) % 10 >= 8"""
BODIES["rec_hits"] = """select "userId", rank, "movieId" from marked where hit = 1"""
BODIES["precision_at_k"] = f"select round(p, 6) precision_at_k from curve where k = {K}"
BODIES["recall_at_k"] = f"select round(r, 6) recall_at_k from curve where k = {K}"
BODIES["map_at_k"] = f"select round(map, 6) map_at_k from curve where k = {K}"
BODIES["precision_at_k_hit_users"] = f"select round(avg(hits / least(n, {K})), 6) precision_at_k from hit_users"
BODIES["recall_at_k_hit_users"] = f"""
select round(avg(hits / n_relevant), 6) recall_at_k from hit_users where n_relevant <= {K}"""
BODIES["metric_curve"] = """
select k, round(p, 6) precision_at_k, round(r, 6) recall_at_k, round(map, 6) map_at_k,
  round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) f1_at_k from curve"""
BODIES["rating_distribution"] = "select rating, count(*) n from ratings group by 1 order by 1"
BODIES["top_recommended"] = """
select t."movieId", title, n_recs from (
  select "movieId", count(*) n_recs from recs group by 1 order by 2 desc, 1 limit 10) t
join movies m on m."movieId" = t."movieId" """
BODIES["genre_popularity"] = """
select coalesce(genre_name, 'Unknown') genre_name, cast(coalesce(sum(n), 0) as bigint) n_recs
from (select "movieId", count(*) n from recs group by 1) r full join genre_rows_all g on g.id = r."movieId" group by 1"""
BODIES["genre_diversity"] = """select "userId", genre_diversity from diversity"""
BODIES["genre_diversity_sketch"] = BODIES["genre_diversity"]

BODIES["ratings_accepted"] = """
select "userId", "movieId", rating, cast(epoch(ts) as bigint) "timestamp", cast(ok as bigint) ok, cast(ln as integer) ln
from rating_events where l_discount < 0.1 and l_tax < 0.08"""
BODIES["ratings_quarantine"] = """
select concat("userId", ',', "movieId", ',', case when l_discount >= 0.1 then 'n/a' else cast(rating as varchar) end, ',',
    case when l_tax >= 0.08 then 'unknown' else cast(cast(epoch(ts) as bigint) as varchar) end, ',', ok, ',', ln) record,
  concat_ws(', ', case when l_discount >= 0.1 then 'rating' end, case when l_tax >= 0.08 then 'timestamp' end) reason
from rating_events where l_discount >= 0.1 or l_tax >= 0.08"""
BODIES["unparsed_lists"] = """
select id, list_name, text from (
  select id, unnest(['genres', 'production_companies', 'production_countries']) list_name,
    unnest([genres, production_companies, production_countries]) whole,
    case when id % 17 = 0 then left(whole, length(whole) - 2) else whole end as text
  from movies_raw) z
where not json_valid(replace(replace(text, chr(39), '"'), 'None', 'null'))"""
BODIES["event_profiles_stream"] = """
select cast(ts as date) as day, user_id, count(*) n_events, count(value) n_values, round(avg(value), 6) mean_value
from events where ts is not null group by 1, 2"""


def histogram(source: str, column: str, bins: int) -> str:
    return f"""
select cast(least(coalesce(floor((cast({column} as double) - low) * {bins} / nullif(high - low, 0)) + 1, 1), {bins})
  as bigint) bin, count(*) n
from {source}, (select cast(min({column}) as double) low, cast(max({column}) as double) high from {source}) e group by 1"""


BODIES["genre_diversity_histogram"] = histogram("diversity", "genre_diversity", 10)
BODIES["recommended_avg_rating"] = 'select "movieId", round(avg_rating, 6) avg_rating from rec_means'
BODIES["recommended_avg_rating_histogram"] = histogram("rec_means", "avg_rating", 20)
BODIES["user_item_pivot"] = 'select "userId", cast(floor("movieId" / 50) as bigint) tile, ' + ", ".join(
    f'sum(case when "movieId" % 50 = {c} then rating else 0 end) c{c}' for c in range(50)
) + ' from (select "userId", "movieId", avg(rating) rating from rating_events group by 1, 2) z group by 1, 2'
BODIES["item_correlation"] = """
select movie_a, movie_b, n_common, round((n * sxy - sa * sb) / nullif(sqrt(n * ssa - sa * sa) * sqrt(n * ssb - sb * sb), 0), 6)
  correlation
from (select a."movieId" movie_a, b."movieId" movie_b, a.s sa, b.s sb, a.ss ssa, b.ss ssb,
        coalesce(sxy, 0) sxy, coalesce(n_common, 0) n_common, (select count(distinct "userId") from ratings) n
      from heat_map_items a join heat_map_items b on a."movieId" < b."movieId"
      left join (select x."movieId" i, y."movieId" j, sum(x.rating * y.rating) sxy, count(*) n_common
                 from (select * from ratings where "movieId" in (select "movieId" from heat_map_items)) x
                 join (select * from ratings where "movieId" in (select "movieId" from heat_map_items)) y
                   on x."userId" = y."userId" and x."movieId" < y."movieId" group by 1, 2) c
        on i = a."movieId" and j = b."movieId") z"""
BODIES["popular_vs_unpopular"] = f"""
select cast(coalesce(sum(n) filter (vote_count > {MIN_VOTES}), 0) as bigint) popular_recs,
  cast(coalesce(sum(n) filter (vote_count <= {MIN_VOTES}), 0) as bigint) unpopular_recs
from (select "movieId", count(*) n from recs group by 1) r join movies m on m."movieId" = r."movieId" """


def sql(name: str) -> str:
    """The query with the table expressions it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"\w+", text))
        for cte in CTES:
            if cte in words and cte not in needed:
                visit(CTES[cte])
                if cte not in needed:
                    needed.append(cte)

    visit(BODIES[name])
    body = BODIES[name].strip()
    if not needed:
        return body
    return "with " + ",\n".join(f"{c} as ({CTES[c].strip()})" for c in needed) + "\n" + body


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}
