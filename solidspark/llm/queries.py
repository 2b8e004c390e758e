"""Queries of the numbered operators over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solidspark.llm import decontam, html_extract, linedup, lm, minhash, packing, quality, resample, sharding, simhash, substring, sumsquares, turns
from solidspark.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 16)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"), "text")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", "best_match", F.array_join("item_ids", ",").alias("item_ids"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "text")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprints(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(table(spark, sf_dir, "conversations"))


def op12_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sumsquares.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _gone_sql(units: str, runs: str, glue: str, n: str) -> str:
    """Repeated runs of units, on texts instead of hashes. units: a list of the text; runs: selects (doc_id, i, j, k), places and key of a run, from lists and units."""
    return f"""
    with lists as (select doc_id, text, case when text is null or text = '' then []::varchar[] else {units} end us from documents),
    trimmed as (select doc_id, list_transform(us, lambda u: trim(u, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) ss from lists),
    units as (select doc_id, unnest(range(len(us))) pos, unnest(us) unit from lists),
    {runs},
    firsts as (select doc_id, i, j, (row_number() over (partition by k order by doc_id, i)) > 1 later from runs),
    gone as (select distinct doc_id, unnest(range(i, j + 1)) pos from firsts where later),
    kept as (select u.doc_id, count(*) {n}, count(g.pos) n_removed,
                    coalesce(string_agg(case when g.pos is null then unit end, {glue} order by u.pos), '') text
             from units u left join gone g on u.doc_id = g.doc_id and u.pos = g.pos group by 1)
    select l.doc_id, coalesce(k.{n}, 0)::bigint {n}, coalesce(n_removed, 0)::bigint n_removed, case when n_removed > 0 then k.text else l.text end as text
    from lists l left join kept k on l.doc_id = k.doc_id"""


def _spans_sql() -> str:
    """Of all spans that hold enough: those that hold no shorter one with the same start or with the same end."""
    blank, other = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    sentences = rf"regexp_extract_all(text, '(?s){blank}*{other}.*?(?:[.!?]{blank}+|\n{blank}*|\z)')"
    runs = rf"""sized as (select doc_id, ss, unnest(range(len(ss))) pos, unnest(ss) s from trimmed),
    summed as (select doc_id, pos, length(s) n, len(regexp_extract_all(s, '{other}+')) words, sum(length(s) + 1) over (partition by doc_id order by pos) upto from sized),
    fits as (select a.doc_id, a.pos i, b.pos j from summed a join summed b on a.doc_id = b.doc_id and b.pos between a.pos and a.pos + 1
             where case when a.pos = b.pos then a.n >= {substring.ALONE_CHARS} or a.words > {substring.ALONE_WORDS} else true end),
    least_ones as (select doc_id, i, min(j) j from fits group by 1, 2 union select doc_id, max(i), j from fits group by doc_id, j),
    runs as (select doc_id, i, j, array_to_string(ss[i + 1:j + 1], chr(10)) k from least_ones join trimmed using (doc_id))"""
    return _gone_sql(sentences, runs, "''", "n_sentences")


def _lines_sql() -> str:
    runs = """windows as (select doc_id, unnest(range(len(ss) - 2)) i, ss from trimmed where len(ss) >= 3),
    runs as (select doc_id, i, i + 2 j, array_to_string(ss[i + 1:i + 3], chr(10)) k from windows where regexp_matches(array_to_string(ss[i + 1:i + 3], ''), '.'))"""
    return _gone_sql("string_split(text, chr(10))", runs, "chr(10)", "n_lines")


#: Brute force: every pair of sets that share a shingle.
NEAR_SQL = r"""
    with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
    sets as (select doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
                            else list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) end s from words),
    classes as (select min(doc_id) rep, s, len(s) n from sets where len(s) > 0 group by s),
    flat as (select rep, n, unnest(s) g from classes),
    links as (select a.rep x, b.rep y from flat a join flat b on a.g = b.g and a.rep < b.rep
              group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    both_ways as (select x, y from links union all select y, x from links),
    reach as (select rep x, rep y from classes union select r.x, e.y from reach r join both_ways e on r.y = e.x),
    comp as (select x rep, min(y) component_id from reach group by x)
    select d.doc_id, len(d.s)::bigint n_shingles, coalesce(m.component_id, d.doc_id) component_id, coalesce(m.component_id, d.doc_id) = d.doc_id kept
    from sets d left join classes c on d.s = c.s left join comp m on c.rep = m.rep"""


def _leaks_sql() -> str:
    """Spaced seeds as texts instead of hashes, then every aligned window."""
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    whole = ["1" * n for n in range(decontam.LEAST, decontam.SHORT)]
    key = lambda mask: " || ' ' || ".join([f"'{mask}'", *[f"w[i + {k + 1}]" for k, c in enumerate(mask) if c == "1"]])
    seeds = lambda table, ident, mask, more="": f"select {ident}, i, {key(mask)} s from (select {ident}, w, unnest(range(len(w) - {len(mask) - 1})) i from {table} where len(w) >= {len(mask)} {more})"
    of_docs = " union all ".join(seeds("d", "doc_id", m) for m in (*decontam.MASKS, *whole))
    of_items = " union all ".join([*[seeds("b", "item_id", m, f"and len(w) >= {decontam.SHORT}") for m in decontam.MASKS], *[seeds("b", "item_id", m, f"and len(w) = {len(m)}") for m in whole]])
    return f"""
    with d as (select doc_id, {words} w from documents), b as (select item_id, {words} w from benchmark where len({words}) >= {decontam.LEAST}),
    ds as ({of_docs}), bs as ({of_items}),
    hits as (select distinct doc_id, item_id, ds.i - bs.i shift from ds join bs using (s)),
    aligned as (select doc_id, item_id, shift, d.w dw, b.w bw, least(20, len(b.w)) n, unnest(range(len(b.w))) j
           from hits join d using (doc_id) join b using (item_id)),
    same as (select doc_id, item_id, shift, n, j, (j + shift >= 0 and j + shift < len(dw) and dw[j + shift + 1] is not distinct from bw[j + 1])::int e from aligned),
    runs as (select doc_id, item_id, n, sum(e) over (partition by doc_id, item_id, shift order by j rows between 19 preceding and current row) m from same),
    found as (select doc_id, item_id, max(m) m from runs group by doc_id, item_id, n having max(m) >= case when n < {decontam.SHORT} then n else 0.8 * n end),
    per as (select doc_id, count(*) n, max(m) m, string_agg(item_id::varchar, ',' order by item_id) ids from found group by 1)
    select documents.doc_id, per.n is not null contaminated, coalesce(per.n, 0)::bigint n_items, coalesce(per.m, 0)::bigint best_match, coalesce(ids, '') item_ids
    from documents left join per on documents.doc_id = per.doc_id"""


def _crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, bit by bit: a byte enters the register, which then moves by eight bits."""
    bits = f"list_transform(range(8 * strlen({text})), lambda k: case when k % 8 = 0 then ('0x' || substr(hex({text}), (k // 4 + 1)::int, 2))::ubigint else 0::ubigint end)"
    step = "lambda c, b: xor(xor(c, b) >> 1, 3988292384::ubigint * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {bits}), {step}), 4294967295::ubigint)::bigint"


#: The repair of each whole conversation, turn by turn.
_REPAIR_SQL = rf"""
    with recursive coded as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 code from conversations),
    damaged as (select conv_id, turn, case when code = 4 then 'user' else role end as role, case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                       unnest(range(case when code = 3 then 2 else 1 end)) copy from coded where code <> 0),
    placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) i, left(role, 1) c, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) z from damaged),
    seen as (select *, row_number() over (partition by conv_id, role, text order by i) > 1 again, lag(c) over (partition by conv_id order by i) || c pair from placed),
    judged as (select *, case when z = '' then 'b' when again then 'd' when z not in ('.', '!', '?') then 't' else '' end fault from seen),
    totals as (select conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint gaps, count(*) filter (fault = 'b') blank, count(*) filter (fault = 'd') duplicate,
                      count(*) filter (fault = 't') truncated, count(*) filter (pair not in ('su', 'ua', 'au')) illegal from judged group by 1),
    moves(q, c, op, price, t) as (values (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3), (3, 'u', 'K', 0, 2),
                      (0, '', 'R', 2, 2), (1, '', 'R', 2, 2), (2, '', 'R', 2, 3), (3, '', 'R', 2, 2), (0, '', 'D', 3, 0), (1, '', 'D', 3, 1), (2, '', 'D', 3, 2), (3, '', 'D', 3, 3)),
    inserts(s, q, k) as (values (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (2, 2, 2), (3, 3, 0), (3, 2, 1), (3, 3, 2)),
    said(s, whom) as (values (0, 'user'), (1, 'user'), (2, 'assistant'), (3, 'user')),
    edges as (select conv_id, i, s, t, 2 * k + price + case when op <> 'D' and fault = 't' then 1 else 0 end price, repeat('I', k) || op ext,
                     case k when 0 then [] when 1 then [a.whom || ':'] else [a.whom || ':', b.whom || ':'] end || case op when 'K' then [role || ':' || text] when 'R' then [c3.whom || ':' || text] else [] end lines
              from judged j join moves on (op = 'K' and moves.c = j.c and fault not in ('b', 'd')) or (op = 'R' and fault not in ('b', 'd')) or op = 'D'
                   join inserts using (q) join said a using (s) join said b on b.s = case when inserts.s = 2 then 3 else 2 end join said c3 on c3.s = inserts.q),
    run(conv_id, i, t, cost, audit, lines) as (
        select conv_id, 0::bigint, 0, 0::bigint, '', []::varchar[] from totals
        union all select conv_id, i, t, best.cost, best.audit, best.lines from (
            select e.conv_id, e.i, e.t, min({{'cost': r.cost + e.price, 'audit': r.audit || e.ext, 'lines': r.lines || e.lines}}) best
            from run r join edges e on r.conv_id is not distinct from e.conv_id and e.i = r.i + 1 and e.s = r.t group by all)),
    best as (select run.conv_id, min({{'cost': cost + case t when 1 then 4 when 2 then 2 else 0 end, 'audit': audit || case t when 1 then 'II' when 2 then 'I' else '' end,
                    'lines': lines || case t when 1 then ['user:', 'assistant:'] when 2 then ['assistant:'] else [] end}}) e
             from run join totals on run.conv_id is not distinct from totals.conv_id and run.i = totals.n group by 1)
    select o.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, coalesce(e.cost, 0)::bigint as cost,
           coalesce(e.audit, '') as audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) repaired_sha256
    from (select distinct conv_id from conversations) o left join totals t on o.conv_id is not distinct from t.conv_id left join best b on o.conv_id is not distinct from b.conv_id"""

#: Every feature's bucket, counted; the highest scores by a window over all.
_RESAMPLE_SQL = rf"""
    with words_of as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
    features as (select doc_id, len(w) n_words, w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) f from words_of),
    targets as (select unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) f
                from (select coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from benchmark)),
    each as (select doc_id, unnest(f) f from features), of_doc as (select doc_id, f, count(*) n from each group by all),
    of_target as (select f, count(*) n from targets group by 1),
    codes as (select f, {_crc_sql("f")} % 10000 b from (select distinct f from of_doc union select f from of_target)),
    s as (select b, sum(n) n from of_doc join codes using (f) group by 1), t as (select b, sum(n) n from of_target join codes using (f) group by 1),
    gains as (select b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from s) + 10000)::double / ((coalesce(s.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from t) + 10000)::double)))::bigint gain
              from (select unnest(range(10000)) b) left join s using (b) left join t using (b)),
    weights as (select doc_id, floor(sum(n * gain)::double / sum(n))::bigint weight from of_doc join codes using (f) join gains using (b) group by 1),
    scores as (select doc_id, n_words, len(f)::bigint n_features, coalesce(weight, 0) weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || doc_id), 8))::bigint + 0.5::double) / 4294967296)))::bigint score
               from features left join weights using (doc_id)),
    ranks as (select doc_id, row_number() over (order by score desc, doc_id) r from scores where n_words >= 20)
    select doc_id, n_features, weight, score, case when r <= 25 * (select count(*) from ranks) // 100 then r end as rank from scores left join ranks using (doc_id)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_sharding, op2_lm_scoring, op3_quality_classifier, op4_minhash_near_dedup, op5_substring_dedup, op6_benchmark_decontamination, op7_best_fit_packing, op8_line_dedup, op9_html_extraction, op10_document_fingerprints,
             op11_conversation_repair, op12_sum_of_squares_packing, op13_importance_resampling)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_minhash_near_dedup": NEAR_SQL,
        "op5_substring_dedup": _spans_sql(),
        "op6_benchmark_decontamination": _leaks_sql(),
        "op8_line_dedup": _lines_sql(),
        "op11_conversation_repair": _REPAIR_SQL,
        "op13_importance_resampling": _RESAMPLE_SQL,
    }
