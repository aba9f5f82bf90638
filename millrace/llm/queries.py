"""The registered forms of the corpus operators, with SQL checks where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import Tables, open_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(tables)`` under its own name; ``sql`` gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(open_tables(spark, sf_dir))
        if sql:
            CHECKS[fn.__name__] = sql.strip()
        return fn

    return register


def _crc(modulus: int):
    """crc32 of the id as text, modulo ``modulus``; rows without an id get null."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


_WORD = r"[^\x20\x09-\x0D]+"


@query(rf"""
    with d as (
        select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
        from documents
    ), counted as (
        select doc_id, cast(len(w) as bigint) as n_words,
            cast(length(array_to_string(w, '')) as bigint) as word_chars,
            cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
            length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_upper,
            length(t) - length(regexp_replace(t, '[A-Za-z]|[^\x00-\x7F]', '', 'g')) as n_letters
        from d
    ), lines as (
        select doc_id, line, count(*) as n
        from (select doc_id, unnest(string_split(t, chr(10))) as line from d) as l
        where regexp_matches(line, '{_WORD}') group by all
    ), line_counts as (
        select doc_id, sum(n) as n_lines, cast(sum(n - 1) as bigint) as n_dup_lines from lines group by 1
    ), spans as (
        select doc_id, unnest(generate_series(1, len(w) - 7)) as i, w from d where len(w) >= 8
    ), twice as (
        select doc_id, list(i) as spots from spans
        group by doc_id, array_to_string(w[i : i + 7], ' ') having count(*) > 1
    ), covered as (
        select doc_id, count(distinct p) as n_repeat_words
        from (select doc_id, a + k as p from (select doc_id, unnest(spots) as a from twice), range(8) as r(k))
        group by 1
    ), all_of as (
        select doc_id, n_words, word_chars, n_symbols, n_upper, n_letters,
            coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
            coalesce(n_repeat_words, 0) as n_repeat_words
        from counted left join line_counts using (doc_id) left join covered using (doc_id)
    ), judged as (
        select *, n_words < 20 as few, 100 * n_repeat_words > 30 * n_words as repeated,
            100 * n_symbols > 30 * n_words as symbols, 100 * n_dup_lines > 50 * n_lines as lines,
            n_letters >= 100 and 100 * n_upper > 50 * n_letters as upper_case,
            n_words > 0 and (word_chars < 2 * n_words or word_chars > 25 * n_words) as word_length,
            2 * n_letters < word_chars as no_letters
        from all_of
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few or repeated as base_failed,
        not (few or repeated or symbols or lines) as kept,
        cast(few::int + 2 * repeated::int + 4 * symbols::int + 8 * lines::int + 16 * upper_case::int
            + 32 * word_length::int + 64 * no_letters::int as bigint) as fail_bits
    from judged
""")
def op5_quality_rules(t: Tables) -> DataFrame:
    from millrace.llm.quality_rules import POLICIES, policy_keeps, policy_mask, rule_ledger

    base, chosen = policy_mask(POLICIES["base"]), policy_mask(POLICIES["v1"])
    return rule_ledger(t.documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~policy_keeps(base)).alias("base_failed"), policy_keeps(base | chosen).alias("kept"), "fail_bits",
    )


@query()
def op8_packing(t: Tables) -> DataFrame:
    import public_tokenizers

    from millrace.llm.packing import pack

    return pack(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@query()
def op3_language_id(t: Tables) -> DataFrame:
    from millrace.llm.langid import fit_language_model, identify_language

    model = fit_language_model(t.documents, _crc(5) != 0)
    return identify_language(t.documents, model, _crc(5) == 0)


@query()
def op4_toxicity(t: Tables) -> DataFrame:
    from millrace.llm.toxicity import fit_toxicity_model, score_toxicity

    model = fit_toxicity_model(t.documents, t.labels, _crc(3) != 1)
    return score_toxicity(t.documents, model, _crc(3) == 1)


@query()
def op7_quality_classifier(t: Tables) -> DataFrame:
    from millrace.llm.quality_model import fit_quality_model, judge_quality

    return judge_quality(t.documents, fit_quality_model(t.documents))


@query()
def op2_near_duplicates(t: Tables) -> DataFrame:
    from millrace.llm.neardup import near_duplicates

    return near_duplicates(t.documents, size=3, part=85, whole=100)


@query(rf"""
    with sized as (
        select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as bigint) as size,
            md5('mix-1|' || coalesce(cast(doc_id as varchar), '')) as key
        from documents
    ), ranked as (
        select source, source_size, row_number() over (order by source nulls last) as source_rank
        from (select source, cast(sum(size) as bigint) as source_size from sized group by source)
    ), weighed as (
        select *, case (source_rank - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight,
            source_size * 2 as most, cast(sum(source_size) over () as bigint) * 1.5::double as budget
        from ranked
    ), leveled as (
        select *, row_number() over up as place,
            (budget - coalesce(cast(sum(most) over (up rows between unbounded preceding and 1 preceding) as bigint), 0))
                / cast(sum(weight) over (up rows between current row and unbounded following) as bigint) as level
        from weighed window up as (order by most / weight, source_rank)
    ), targets as (
        select source, source_size, source_rank, budget, least(most::double, coalesce(weight *
            (select level from leveled where most / weight >= level order by place limit 1), most::double)) as target
        from leveled
    ), queued as (
        select s.doc_id, s.size, s.key, t.source_rank, c.copy, budget, (c.copy * source_size + cast(sum(s.size) over (
                partition by t.source_rank, c.copy order by s.key, s.doc_id rows unbounded preceding) as bigint))
                / target as finish
        from sized s join targets t on s.source is not distinct from t.source, (values (0), (1)) as c(copy)
        where s.size > 0
    ), taken as (
        select doc_id, sum(size) as taken from (
            select doc_id, size, budget, sum(size) over (
                order by finish, source_rank, copy, key, doc_id rows unbounded preceding) as running
            from queued
        ) where running <= budget group by doc_id
    )
    select doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
    from sized s join targets t on s.source is not distinct from t.source left join taken using (doc_id)
""")
def op6_source_mix(t: Tables) -> DataFrame:
    from millrace.llm.mixing import mix

    return mix(t.documents)


@query()
def op1_fingerprints(t: Tables) -> DataFrame:
    from millrace.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(t.documents)


@query(r"""
    with rows as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all
        select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
    ), escaped as (
        select *, length(regexp_replace(replace(text, '\', '\\'),
            '(<)(/?s>|image>|audio>|document>|other>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')) as body,
            length(regexp_replace(replace(role, '\', '\\'),
            '(<)(/?s>|image>|audio>|document>|other>)|(\[)(/?INST\])|(\n)', '\1\3\5\\\2\4', 'g')) as head
        from rows
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
            as loss_sha256,
        cast(sum(head + 1 + body + case when role = 'assistant' then 7 else 13 end) as bigint) as formatted_chars
    from escaped group by conv_id
""")
def op9_chat_format(t: Tables) -> DataFrame:
    from millrace.llm.chat import format_conversations, read_back

    marks = t.spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = t.conversations.select("conv_id", "turn", "role", "text").unionByName(marks)
    return read_back(format_conversations(turns))


@query()
def op10_secret_scan(t: Tables) -> DataFrame:
    from millrace.llm.secrets import scan_secrets

    return scan_secrets(t.documents, path=F.col("source"))


_LEAF = """sha256(concat(
            coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-'),
            coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
            coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-'),
            coalesce(strlen({text}) || ':' || {text}, '-')))"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
    with recursive coded as (
        select *, xor(4294967295, list_reduce(
            list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda d: unicode(d)::bigint)),
            lambda c, d: list_reduce(list_prepend(xor(c, d), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) as crc
        from documents
    ), leaves as (
        select doc_id, lang, {_LEAF.format(text='text')} as leaf,
            case when crc % 3 = 0 then {_LEAF.format(text=_LOWER)} else {_LEAF.format(text='text')} end as found
        from coded
    ), placed as (
        select *, dense_rank() over (order by lang nulls first) - 1 as tree, row_number() over (
            partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as width
        from leaves
    ), nodes as (
        select tree, 0 as level, idx, width, leaf as digest from placed
        union all
        select tree, level + 1, idx // 8, (width + 7) // 8, sha256(string_agg(digest, '' order by idx))
        from nodes where width > 1 group by tree, level, idx // 8, width
    ), subroots as (
        select tree as idx, digest as subroot, count(*) over () as width from nodes where width = 1
    ), crown as (
        select 0 as level, idx, width, subroot as digest from subroots
        union all
        select level + 1, idx // 8, (width + 7) // 8, sha256(string_agg(digest, '' order by idx))
        from crown where width > 1 group by level, idx // 8, width
    ), every_node as (
        select tree, level, idx, width, digest from nodes
        union all select -1, level, idx, width, digest from crown
    ), beside as (
        select a.tree, a.level, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') as l,
            coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as r
        from every_node a join every_node b on a.tree = b.tree and a.level = b.level and a.idx // 8 = b.idx // 8
        where a.width > 1 group by a.tree, a.level, a.idx
    ), climb as (
        select row_number() over () as rid, doc_id, leaf, tree as home, tree, 0 as level, idx, width, found as folded, '' as proof
        from placed
        union all
        select * from (
            select rid, doc_id, leaf, home, b.tree, c.level + 1, c.idx // 8, (c.width + 7) // 8, sha256(l || folded || r), proof || l || r
            from climb c join beside b on c.tree = b.tree and c.level = b.level and c.idx = b.idx where c.width > 1
            union all
            select rid, doc_id, leaf, home, -1, 0, s.idx, s.width, folded, proof
            from climb c join subroots s on c.tree = s.idx where c.width = 1 and c.tree >= 0
        )
    )
    select doc_id, leaf, subroot, (select digest from crown where width = 1) as root, sha256(proof) as proof_sha256,
        folded as folded_root, folded = (select digest from crown where width = 1) as verified
    from climb c join subroots s on c.home = s.idx where c.tree = -1 and c.width = 1
""")
def op13_merkle_manifest(t: Tables) -> DataFrame:
    from millrace.llm.manifest import build_manifest, prove, tampered_leaf

    return prove(build_manifest(t.documents, tampered_leaf()))


@query()
def op12_simhash_duplicates(t: Tables) -> DataFrame:
    from millrace.llm.simhash import simhash_duplicates

    found = simhash_duplicates(t.documents, size=4, most=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_PIECES = r"[.,;:!?\x0A-\x0D]"


@query(rf"""
    with pieces as (
        select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PIECES}')), '[^\x20\x09]+') as w
        from documents
    ), spots as (
        select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from pieces, range(1, 6) as sizes(m) where len(w) >= m
    ), counted as (
        select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase, count(*) as f from spots group by all
    ), totals as (
        select lang, cast(sum(f) as bigint) as n from counted where m = 1 group by lang
    ), candidates as (
        select lang, m, phrase, string_split(phrase, ' ') as w, f as a from counted where m >= 2 and f >= 100
    ), inside as (
        select distinct lang, array_to_string(w[i : i + k - 1], ' ') as phrase, a
        from (select *, unnest(range(1, m - k + 2)) as i from candidates, range(2, 5) as shorter(k) where k < m)
    ), cuts as (
        select c.lang, c.phrase, c.a, t.n, k, l.f as l, r.f as r,
            cast((1000::hugeint * c.a * t.n) // (l.f::hugeint * r.f) as bigint) as score
        from (select *, unnest(range(1, m)) as k from candidates) c join totals t using (lang)
        join counted l on l.lang = c.lang and l.phrase = array_to_string(w[1 : k], ' ')
        join counted r on r.lang = c.lang and r.phrase = array_to_string(w[k + 1 :], ' ')
    ), lowest as (
        select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
    ), ranked as (
        select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest c
        where not exists (select 1 from inside i where i.lang = c.lang and i.phrase = c.phrase and i.a >= c.a)
    )
    select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
""")
def op11_phrases(t: Tables) -> DataFrame:
    from millrace.llm.phrases import mine_phrases

    return mine_phrases(t.documents, least=100, top=2000)
