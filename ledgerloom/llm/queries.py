"""The operators of this subpackage over the tables of the driver, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contamination, conversation_repair, fuzzy_lines, hard_negatives, language, metric_tree, near_duplicates, packing, personal_data, quality, sharding, token_files, toxicity


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(divisor: int):
    """crc32 of doc_id as text, modulo divisor; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def not_held_out(divisor: int, remainder: int):
    """The rows whose labels may be learnt from."""
    return _remainder(divisor) != remainder


def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data.personal_data(table(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return language.identify(table(spark, folder, "documents"), learn=not_held_out(5, 0), held_out=held_out)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Class, size and links of every document."""
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


SHARDS = [f"shard-{k:03d}" for k in range(64)]


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Slot and shard of every document."""
    placed = sharding.place(table(spark, folder, "documents"), "doc_id", SHARDS)
    return placed.select("doc_id", "n_chars", "slot", "shard")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = quality.classify(documents, labels, learn=not_held_out(3, 1))
    return rows.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and dropped lines of every document, with a digest of the text that stays."""
    rows = fuzzy_lines.without_repeated_lines(table(spark, folder, "documents"), settings=fuzzy_lines.EVERY_LINE)
    return rows.select("doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Offsets and checksums of all documents, from files written before."""
    path = token_files.scratch(spark)
    token_files.write(table(spark, folder, "documents"), path, tokenizer_path("word_bpe_49k.json"), end=1)
    return token_files.read(spark, path)


def op9_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents."""
    return contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_metric_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector."""
    return metric_tree.top_k(table(spark, folder, "embeddings"), k=5, is_query=F.col("vec_id") % 50 == 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with lines dropped, emptied, cut, repeated and given to users, by a hash of id and turn."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", *named, (F.crc32(key.cast("binary")) % 20).alias("harm")).filter("harm <> 0")
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(harm == 4, "user").otherwise(F.col("role"))})
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.when(harm == 3, 2).otherwise(1)))).drop("col")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cost and audit of every damaged conversation, with a digest of its repaired lines."""
    conversations = table(spark, folder, "conversations")
    repaired = conversation_repair.repair(damaged(conversations))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = conversations.select("conv_id").distinct().alias("c")
    for part in (repaired.conversations, conversation_repair.digests(repaired.lines)):
        renamed = part.withColumnRenamed("conv_id", "_conv")
        found = found.join(renamed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    nothing = {**dict.fromkeys(counts, F.lit(0).cast("long")), "audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(b""), 256)}
    return found.select("conv_id", *(F.coalesce(c, empty).alias(c) for c, empty in nothing.items()))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector, some labels changed."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), is_anchor=F.col("vec_id") % 50 == 0, label=label)


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = toxicity.classify(documents, labels, learn=not_held_out(5, 0))
    return rows.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def statements() -> dict[str, str]:
    table = ", ".join(map(str, sharding.lookup_table(SHARDS)))
    place = f"('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint % {sharding.SLOTS}"
    sharded = f"""
        select doc_id, n_chars, slot, 'shard-' || lpad(cast(([{table}])[slot + 1] as varchar), 3, '0') as shard
        from (select doc_id, n_chars, {place} as slot from documents)"""
    nearest = """
        with v as (
            select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
        ), scored as (
            select q.row, q.vec_id as query_id, c.vec_id,
                   cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
            from v q join v c on q.row <> c.row
            where q.vec_id % 50 = 0
        ), ranked as (
            select *, cast(row_number() over (partition by row order by score desc, vec_id) as integer) as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5"""
    repaired = """
        with recursive checks as (
            select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t
        ), named as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
            from conversations
        ), harmed as (
            select conv_id, turn, role, text, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda i: cast(ascii(substr(name, i, 1)) as bigint))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as harm
            from named, checks
        ), damaged as (
            select conv_id, turn, case when harm = 4 then 'user' else role end as role,
                   case harm when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                   unnest(range(case when harm = 3 then 2 else 1 end)) as copy
            from harmed where harm <> 0
        ), keyed as (
            select *, md5(concat_ws(':', coalesce(length(cast(conv_id as varchar)), -1), length(role), cast(conv_id as varchar), role, text)) as key,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as stripped
            from damaged
        ), placed as (
            select *, row_number() over (partition by conv_id order by turn nulls first, key, copy) as pos,
                   case when substr(role, 1, 1) in ('s', 'u', 'a') then substr(role, 1, 1) else '?' end as initial
            from keyed
        ), lines as (
            select *, stripped = '' as blank, again and stripped <> '' as duplicate,
                   not again and stripped <> '' and right(stripped, 1) not in ('.', '!', '?') as truncated,
                   coalesce(lag(initial) over (partition by conv_id order by pos) || initial not in ('su', 'ua', 'au'), false) as illegal
            from (select *, pos > min(pos) over (partition by conv_id, key) as again from placed)
        ), counted as (
            select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                   sum(blank::int)::bigint as blank, sum(duplicate::int)::bigint as duplicate,
                   sum(truncated::int)::bigint as truncated, sum(illegal::int)::bigint as illegal
            from lines group by conv_id
        ), inserts(before, state, cost, audit, added) as (
            values (0, 0, 0, '', []), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
                   (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
                   (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (2, 2, 10, 'II', ['assistant:', 'user:']),
                   (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:']), (3, 3, 10, 'II', ['user:', 'assistant:'])
        ), edits(state, initial, symbol, cost, after, role) as (
            select s, i, 'D', 2, s, null from unnest(range(4)) a(s), unnest(['s', 'u', 'a', '?']) b(i)
            union all
            select s, i, 'R', 1, case s when 2 then 3 else 2 end, case s when 2 then 'assistant' else 'user' end
            from unnest(range(4)) a(s), unnest(['s', 'u', 'a', '?']) b(i)
            union all
            values (0, 's', 'K', 0, 1, null), (0, 'u', 'K', 0, 2, null), (1, 'u', 'K', 0, 2, null), (3, 'u', 'K', 0, 2, null), (2, 'a', 'K', 0, 3, null)
        ), walk as (
            select conv_id, 0::bigint as pos, 0 as state, 0 as cost, '' as audit, []::varchar[] as body from counted
            union all
            select conv_id, pos, state, cost, audit, body from (
                select w.conv_id, w.pos + 1 as pos, e.after::int as state,
                       (w.cost + i.cost + e.cost + case when l.truncated and e.symbol <> 'D' then 5 else 0 end)::int as cost,
                       w.audit || i.audit || e.symbol as audit,
                       w.body || i.added || case when e.symbol = 'D' then [] else [coalesce(e.role, l.role) || ':' || l.text] end as body,
                       row_number() over (partition by w.conv_id, e.after order by
                           w.cost + i.cost + e.cost + case when l.truncated and e.symbol <> 'D' then 5 else 0 end,
                           w.audit || i.audit || e.symbol) as choice
                from walk w join lines l on l.conv_id is not distinct from w.conv_id and l.pos = w.pos + 1
                join inserts i on i.before = w.state
                join edits e on e.state = i.state and e.initial = l.initial and (e.symbol = 'D' or not (l.blank or l.duplicate))
            ) where choice = 1
        ), ended as (
            select w.conv_id, w.cost + i.cost as cost, w.audit || i.audit as audit, w.body || i.added as body,
                   row_number() over (partition by w.conv_id order by w.cost + i.cost, w.audit || i.audit) as choice
            from walk w join counted c on c.conv_id is not distinct from w.conv_id and c.n = w.pos
            join inserts i on i.before = w.state and i.state in (0, 3)
        )
        select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost,
               coalesce(audit, '') as audit, sha256(coalesce(array_to_string(body, chr(10)), '')) as repaired_sha256
        from (select distinct conv_id from conversations) o
        left join counted c on c.conv_id is not distinct from o.conv_id
        left join ended e on e.conv_id is not distinct from o.conv_id and e.choice = 1"""
    mined = """
        with v as (
            select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
        ), scored as (
            select a.row, a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
                   cast(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
            from v a join v c on a.row <> c.row
            where a.vec_id % 50 = 0
        ), positives as (
            select row, anchor_id, vec_id as positive_id, score as positive_score,
                   row_number() over (partition by row order by score desc, vec_id) as place
            from scored where same qualify place <= 5
        )
        select p.anchor_id, positive_id, cast(row_number() over (partition by p.row, place order by score desc, vec_id) as integer) as rank,
               vec_id as negative_id, positive_score, score as negative_score
        from positives p join scored s on s.row = p.row and not same
         and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify rank <= 3"""
    return {"op12_hard_negatives": mined, "op4_sharding": sharded, "op10_metric_tree": nearest, "op11_conversation_repair": repaired}
