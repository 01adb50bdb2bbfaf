"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinse.llm import (
    chosen_path,
    hard_negatives,
    kneser_ney,
    language_mixture,
    license_rules,
    line_spread,
    mixing,
    pivot_topk,
    shard_graphs,
    spaced_seeds,
    token_orc,
    vector_codes,
    warc,
)
from rinse.llm.shared import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_orc")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    to = shared_folder(spark, "tokens")
    token_orc.write_tokens(table(spark, folder, "documents"), to, public_tokenizer("byte_bpe_50k.json"))
    return token_orc.token_index(spark, to)


def id_remainder(divisor: int):
    """The remainder of the checksum of doc_id as text; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


@query("op2_language_mixture")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", id_remainder(4) == 2)
    model = language_mixture.learn_languages(docs.where(~F.col("held_out")))
    found = language_mixture.predict_languages(docs.select("doc_id", "text", "held_out"), model)
    return found.select(
        "doc_id",
        "held_out",
        F.col("language.pred").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.languages").alias("languages"),
        F.col("language.fits").alias("fits"),
    )


MIX_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5(coalesce(doc_id::varchar, '')) as key
  from documents
), sources as (
  select source, sum(size)::double as z,
    [3.0::double, 1.0::double, 2.0::double][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
  from sized group by source
), ordered as (
  select *, 2.0::double * z / w as room, sum(z) over () * 1.5::double as budget, sum(w) over () as ws from sources
), levels as (
  select *, (budget - coalesce(sum(2.0::double * z) over before, 0.0::double)) / (ws - coalesce(sum(w) over before, 0.0::double)) as level
  from ordered window before as (order by room, source nulls last rows between unbounded preceding and 1 preceding)
), targets as (
  select source, z, least(2.0::double * z, coalesce((select level from levels where room >= level order by room limit 1) * w, 2.0::double * z)) as target
  from levels
), placed as (
  select doc_id, size, z::bigint as z, target, floor(target)::bigint as words,
    sum(size) over (partition by sized.source order by key, size rows between unbounded preceding and current row)::bigint - size as start
  from sized join targets on sized.source is not distinct from targets.source
)
select doc_id, size, z as source_size, target,
  (greatest(0, least(start + size, words) - least(start, words)) + greatest(0, least(start + size, words - z) - start))::bigint as taken
from placed
"""


@query("op4_mixing", MIX_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.documents.select("doc_id", "size", "source_size", "target", "taken")


# Without masks: of 10 to 15 words with 2 or 3 unequal ones, some 3 words in a row are equal, of 5 to 9 with one unequal
# some 2, and of fewer all. Every shift at which such a run is equal is compared word by word.
SEED_SQL = r"""
with docs as (
  select distinct doc_id, text, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x != '') as w from documents where text is not null
), items as (
  select *, case when len(v) >= 10 then 3 when len(v) >= 5 then 2 else len(v) end as run from (
    select distinct item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x != '') as v from benchmark where text is not null
  ) where len(v) > 0
), item_runs as (
  select item_id, v, run, place, array_to_string(v[place + 1:place + run], ' ') as words
  from (select *, unnest(range(len(v) - run + 1)) as place from items)
), doc_runs as (
  select doc_id, text, w, run, pos, array_to_string(w[pos + 1:pos + run], ' ') as words
  from (select *, unnest(range(len(w))) as pos from docs), (select distinct run from items) where pos + run <= len(w)
), hits as (
  select distinct doc_id, text, w, item_id, v, pos - place as shift from doc_runs join item_runs using (run, words)
), lined as (
  select doc_id, text, item_id, shift, least(15, len(v)) as stretch,
    list_transform(range(greatest(0, -shift), least(len(v), len(w) - shift)), lambda t: (v[t + 1] = w[t + shift + 1])::int) as e
  from hits
), judged as (
  select *, list_max(list_transform(range(greatest(0, len(e) - stretch + 1)), lambda t: list_sum(e[t + 1:t + stretch]))) as agree from lined
), ranked as (
  select *, row_number() over (partition by doc_id, text, item_id order by agree desc, shift) as r
  from judged where agree >= ceil(stretch * 0.8::double)
)
select doc_id, item_id, shift::int as start_word, agree::int as agree, stretch::int as stretch from ranked where r = 1
"""


@query("op8_spaced_seeds", SEED_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = spaced_seeds.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "agree", "stretch")


@query("op5_chosen_path")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return chosen_path.with_classes(docs, chosen_path.jaccard_classes(docs))


WARC_SQL = r"""
with coded as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as hex from pages
), named as (
  select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k:
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || hex[k // 4 * 5 + 1:k // 4 * 5 + 5])::bigint >> (15 - k % 4 * 5)) & 31) + 1)::int]), '') as payload_digest,
    max(page_id) over (partition by hex) as keeper
  from coded
)
select page_id, payload_bytes, payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id != keeper then keeper end as refers_to
from named
"""


@query("op10_warc", WARC_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    to = shared_folder(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), to)
    return warc.page_captures(spark, to)


TOPK_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as w from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, x.vec_id, list_dot_product(q.w, x.w)::bigint as score
  from whole q join whole x on q.vec_id != x.vec_id and len(q.w) = len(x.w) where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query("op6_pivot_topk", TOPK_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5, scale=256.0)


@query("op9_license_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = license_rules.license_scan(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    base = F.transform("licenses.base", lambda x: x["label"])
    more = F.transform("licenses.detections", lambda x: x["label"])
    places = F.transform("licenses.base", lambda x: x["word"])
    sure = F.array_max(F.transform("licenses.detections", lambda x: x["priority"]))
    return found.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.size("licenses.base").cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        (F.coalesce(sure, F.lit(0)) / F.lit(100.0)).alias("score"),
        F.col("licenses.detections").alias("detections"),
    )


LINE_SQL = """
with lines as (
  select doc_id, text, source, generate_subscripts(string_split(text, chr(10)), 1) as pos, unnest(string_split(text, chr(10))) as line from documents
), trimmed as (
  select doc_id, text, source, pos, line, trim(line, ' ' || chr(9) || chr(13)) as own from lines
), bad as (
  select own from trimmed where own != '' group by own having count(distinct coalesce('=' || source, '')) >= 5
), kept as (
  select distinct text, pos, line, own in (select own from bad) as leaves from trimmed
), texts as (
  select text, count(*)::int as n_lines, (count(*) filter (leaves))::int as n_removed,
    md5(coalesce(string_agg(line, chr(10) order by pos) filter (not leaves), '')) as kept_md5
  from kept group by text
)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, kept_md5
from documents left join texts using (text)
"""


@query("op7_line_spread", LINE_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    found = line_spread.without_spread_lines(docs)
    return found.select(
        "doc_id",
        F.col("line_spread.n_lines").alias("n_lines"),
        F.size("line_spread.removed").alias("n_removed"),
        F.md5(F.col("line_spread.kept").cast("binary")).alias("kept_md5"),
    )


@query("op3_kneser_ney")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (id_remainder(5) == 1).alias("held_out"))
    model = kneser_ney.train(docs.where("not held_out"))
    found = kneser_ney.score(docs, model)
    return found.select(
        "doc_id",
        "held_out",
        F.col("lm.n_tokens").alias("n_tokens"),
        F.col("lm.n_known").alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        F.col("lm.base_score").alias("base_score"),
        F.col("lm.score").alias("score"),
        F.col("lm.perplexity").alias("perplexity"),
    )


NEGATIVES_SQL = """
with whole as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(x::double * 256)) as w
  from embeddings
  where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, x.vec_id, a.label = x.label as same, list_dot_product(a.w, x.w)::bigint as score
  from whole a join whole x on a.vec_id != x.vec_id and len(a.w) = len(x.w) where a.vec_id % 50 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score,
    row_number() over (partition by anchor_id order by score desc, vec_id) as place
  from scored where same
), windows as (
  select p.anchor_id, p.positive_id, p.positive_score, n.vec_id as negative_id, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)::int as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
  where p.place <= 5
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from windows where rank <= 3
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.pmod("vec_id", F.lit(50)) == 0, positives=5, negatives=3, low=50, high=95, scale=256.0)


@query("op12_shard_graphs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return shard_graphs.nearest(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, k=20)


def _codes_sql(rounds: int = 2) -> str:
    """Each round assigns, then moves the entries."""
    assigned = """
    {name} as (
      select r, p, min([d, e]) as best from (
        select r, parts.p, e, list_sum(list_transform(list_zip(parts.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from parts join {books} b on parts.p = b.p
      ) group by r, p
    )"""
    moved = """
    sums{k} as (
      select p, e, j, sum(c)::bigint as s, count(*) as n from (
        select parts.p, best[2] as e, generate_subscripts(v, 1) as j, unnest(v) as c from parts join near{k} using (r, p)
      ) group by p, e, j
    ), books{next} as (
      select p, e, coalesce(m.v, old.v) as v from books{k} old left join (
        select p, e, list((s - ((s % n) + n) % n) // n order by j) as v from sums{k} group by p, e
      ) m using (p, e)
    )"""
    steps = []
    for k in range(rounds):
        steps += [assigned.format(name=f"near{k}", books=f"books{k}"), moved.format(k=k, next=k + 1)]
    return f"""
    with kept as (
      select vec_id, label, row_number() over (order by vec_id, embedding) as r,
        list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as w
      from embeddings
      where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), parts as (
      select r, p, w[p * (len(w) // 16) + 1:(p + 1) * (len(w) // 16)] as v from kept, (select unnest(range(16)) as p)
    ), books0 as (
      select p, r - 1 as e, v from parts where r <= 64
    ), {",".join(steps)}, {assigned.format(name="final", books=f"books{rounds}")}, coded as (
      select vec_id, label, string_agg(printf('%02x', best[2]), '' order by p) as code, sum(best[1])::bigint as error
      from final join kept using (r) group by r, vec_id, label
    )
    select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, (
      select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from books{rounds}
    ) as codebooks_sha256
    from coded"""


@query("op13_vector_codes", _codes_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    coded, checksum = vector_codes.vector_codes(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2, scale=256.0)
    return coded.withColumn("codebooks_sha256", F.lit(checksum))
