"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import read_table
from riskloom.llm.decontamination import find_contamination
from riskloom.llm.exact_dedup import tree_merge_dedup
from riskloom.llm.hash_search import hashed_neighbours
from riskloom.llm.language_id import identify_languages
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.mixing import mix_sources
from riskloom.llm.ngram_join import ngram_jaccard_components
from riskloom.llm.phrases import mine_collocations
from riskloom.llm.pii import find_personal_data
from riskloom.llm.quality import classify_quality
from riskloom.llm.quotes import link_quotations
from riskloom.llm.sharding import sampled_splitter_shards
from riskloom.llm.whitening import whiten_embeddings


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(read_table(spark, sf_dir, "conversations"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_splitter_shards(read_table(spark, sf_dir, "documents"), n_shards=16)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_merge_dedup(read_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(read_table(spark, sf_dir, "embeddings"))


def op12_hash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_neighbours(read_table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotes": op1_quotes,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_line_dedup": op4_line_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_hash_search": op12_hash_search,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL = {
    "op1_quotes": r"""
        with recursive m as (select conv_id, turn, role, coalesce(text, '') as text,
                          string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)) as lines from conversations),
        l as (select conv_id, turn, line, len(regexp_replace(regexp_extract(line, '^[\x20\t]*>[>\x20\t]*'), '[^>]', '', 'g')) as level,
                     trim(regexp_replace(translate(regexp_replace(line, '^[\x20\t]*>[>\x20\t]*', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) as normal
              from (select conv_id, turn, unnest(lines) as line from m)),
        o as (select conv_id, normal, min(turn) as origin from l where level = 0 and normal <> '' group by conv_id, normal),
        q as (select l.conv_id, l.turn, l.level, o.origin, count(*) as n from l join o using (conv_id, normal)
              where l.level > 0 and o.origin < l.turn group by all),
        p as (select conv_id, turn, arg_min(origin, (level, -n, -origin)) as parent, sum(n) as n_linked from q group by conv_id, turn),
        r as (select conv_id, turn, parent as root, 1 as steps from p
              union all select r.conv_id, r.turn, p.parent, steps + 1 from r join p on p.conv_id = r.conv_id and p.turn = r.root),
        t as (select conv_id, turn, arg_max(root, steps) as root, max(steps) as steps from r group by conv_id, turn)
        select m.conv_id, m.turn, role,
               trim(array_to_string([x for x in lines if not regexp_matches(x, '^[\x20\t]*>')], chr(10)), chr(10)) as own_text,
               coalesce(c.quote_depth, 0)::int as quote_depth, coalesce(c.n_quoted, 0) as n_quoted,
               coalesce(p.n_linked, 0)::bigint as n_linked, p.parent as parent_turn, coalesce(t.root, m.turn) as root_turn,
               coalesce(t.steps, 0)::bigint as thread_depth,
               row_number() over (partition by m.conv_id order by coalesce(t.root, m.turn), m.turn, role) - 1 as position
        from m left join p on p.conv_id = m.conv_id and p.turn = m.turn left join t on t.conv_id = m.conv_id and t.turn = m.turn
        left join (select conv_id, turn, max(level) as quote_depth, count(*) filter (level > 0 and normal <> '') as n_quoted
                   from l group by conv_id, turn) c on c.conv_id = m.conv_id and c.turn = m.turn""",
    "op2_decontamination": r"""
        with t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
        bw as (select distinct item_id, least(10, len(w)) as k, w[i:i + least(10, len(w)) - 1] as words
               from (select *, unnest(generate_series(1, greatest(1, len(w) - 9))) as i from b where len(w) > 0)),
        dw as (select doc_id, k, i, w[i:i + k - 1] as words
               from (select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
                     from t, (select distinct k from bw) where len(w) >= k)),
        m as (select dw.doc_id, dw.k, dw.i, bw.item_id from dw join bw using (k, words)),
        h as (select doc_id, count(distinct i + j) as n_hit
              from (select distinct doc_id, k, i, unnest(generate_series(0, k - 1)) as j from m) group by doc_id),
        n as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
              from (select distinct doc_id, item_id::varchar as item from m) group by doc_id)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from t left join h using (doc_id) left join n using (doc_id)""",
    "op8_exact_dedup": r"""
        with d as (select doc_id, length(coalesce(text, '')) as n_points,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
                   from documents),
        k as (select *, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size
              from d window w as (partition by text_sha256 order by n_points desc, doc_id nulls last))
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from k""",
    "op9_mixing": r"""
        with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
                          ('0x' || substr(md5(concat_ws('|', 'mix', doc_id::varchar, md5(text))), 1, 9))::bigint as h
                   from documents),
        s as (select source, sum(size)::bigint as source_size,
                     [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
              from d group by source),
        r as (select *, 2.0::double * source_size / w as reach from s),
        l as (select *, (1.5::double * (select sum(source_size) from s)
                         - 2.0::double * coalesce(sum(source_size) over (order by reach, source nulls last
                                                  rows between unbounded preceding and 1 preceding), 0))
                        / sum(w) over (order by reach, source nulls last
                                       rows between current row and unbounded following) as level from r),
        t as (select source, source_size,
                     least(2.0::double * source_size, (select max(level) from l) * w) as target
              from l),
        f as (select *, case when source_size = 0 then 0 else floor(target / source_size) end as full_passes from t),
        c as (select d.*, f.source_size, f.target, f.full_passes, f.target - f.full_passes * f.source_size as rest,
                     sum(d.size) over (partition by d.source order by d.h) as upto,
                     sum(d.size) over (partition by d.source, d.h) as own
              from d join f on d.source is not distinct from f.source)
        select doc_id, size, source_size, target,
               (size * (full_passes + case when rest > 0 and (upto <= rest or (upto - own <= rest
                        and upto - rest <= rest - (upto - own))) then 1 else 0 end))::bigint as taken
        from c""",
    "op13_collocations": r"""
        with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
        w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
        n as (select lang, sum(len(w))::bigint as n from w group by lang),
        g as (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
              from w, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k),
        f as (select lang, k, w[i:i + k - 1] as words, count(*) as f from g group by all having count(*) >= 100),
        d as (select distinct lang, unnest([words[1:k - 1], words[2:k]]) as words, f from f where k > 2),
        c as (select lang, k, words, f as a from f where k > 1 and not exists
              (select 1 from d where d.lang = f.lang and d.words = f.words and d.f = f.f)),
        s as (select lang, words, a, l.f as l, r.f as r, n, cut,
                     ((1000::hugeint * a * n) // (l.f::hugeint * r.f))::bigint as score
              from (select *, unnest(generate_series(1, k - 1)) as cut from c) x join n using (lang)
              join f l on l.lang = x.lang and l.words = x.words[1:cut] join f r on r.lang = x.lang and r.words = x.words[cut + 1:k]),
        o as (select *, row_number() over (partition by lang, words order by score, cut) as pick,
                     array_to_string(words, ' ') as phrase from s),
        t as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o where pick = 1)
        select lang, rank, phrase, a, l, r, n, score from t where rank <= 2000""",
}
