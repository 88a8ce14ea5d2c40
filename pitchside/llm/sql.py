"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

from pitchside.llm.mixing import DIMENSIONS, Mix
from pitchside.llm.outliers import Limits

#: A text's words, as a list.
WORDS = (
    "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
)


def _removed(letters: str) -> str:
    return (
        "(length(coalesce(text, ''))"
        f" - length(regexp_replace(coalesce(text, ''), '[{letters}]+', '', 'g')))"
    )


def mixing(docs: str, mix: Mix = Mix()) -> str:
    """CTEs that end in ``mixed``: the rows of ``docs`` with their verdicts."""
    many = f"> {mix.percent} * length(coalesce(text, ''))"
    weights = {
        "source": f"pow(base, {mix.source_power}::double)",
        "lang": f"pow(base, {mix.lang_power}::double)",
        "topic": "case when base = 0 then 0 "
        + " ".join(f"when topic = '{k}' then {v}::double" for k, v in mix.topics.items())
        + " else 0 end",
    }
    out = [
        f"counted as (select *, len({WORDS}) as _tokens, coalesce(source, '') as _source,"
        f" coalesce(lang, '') as _lang from {docs})",
        "featured as materialized (select *, case when _tokens = 0 then 'brief'"
        f" when 100 * {_removed('#*$%&|<>')} {many} then 'marked'"
        f" when 100 * {_removed('0-9')} {many} then 'figures'"
        f" when _tokens < {mix.brief_words} then 'brief' else 'prose' end as _topic from counted)",
        "cells as materialized (select _source as source, _lang as lang, _topic as topic,"
        " sum(_tokens)::double as base from featured group by all)",
    ]
    total = f"{mix.share}::double * (select sum(base) from cells)"

    def levels(name: str, rows: str) -> str:
        """The factor by which ``rest`` brings ``base`` to ``target``, no row above its base."""
        before = "rows between unbounded preceding and 1 preceding"
        onward = "rows between current row and unbounded following"
        given = f"coalesce(sum(base) over (partition by {name} order by rest desc {before}), 0)"
        still = f"sum(base * rest) over (partition by {name} order by rest desc {onward})"
        supply = f"sum(base) over (partition by {name})"
        lines = (
            f"select {name}, (least(target, supply) - {given}) / {still} as line from (select *,"
            f" {supply} as supply from ({rows})) where base > 0 and rest > 0"
        )
        return f"select {name}, greatest(max(line), 0) as level from ({lines}) group by all"

    for name in DIMENSIONS:
        weighed = f"select 0 as every, base, weight / base as rest, {total} as target from weighed_{name}"
        out += [
            f"sums_{name} as (select {name}, sum(base) as base from cells group by all)",
            f"weighed_{name} as (select {name}, base, {weights[name]} as weight from sums_{name})",
            f"targets_{name} as materialized (select {name}, least(base, weight * coalesce((select"
            f" level from ({levels('every', weighed)})), 0)) as target from weighed_{name})",
            f"{name}_0 as (select {name}, 1::double as {name}_factor from targets_{name})",
        ]
    step = dict.fromkeys(DIMENSIONS, 0)
    for turn in range(1, mix.rounds + 1):
        for name in DIMENSIONS:
            others = [x for x in DIMENSIONS if x != name]
            joined = " ".join(f"join {x}_{step[x]} using ({x})" for x in others)
            product = " * ".join(f"{x}_factor" for x in others)
            rows = (
                f"select {name}, base, {product} as rest, target from cells {joined}"
                f" join targets_{name} using ({name})"
            )
            out.append(
                f"{name}_{turn} as materialized (select {name}, coalesce(level, 0) as {name}_factor"
                f" from targets_{name} left join ({levels(name, rows)}) using ({name}))"
            )
            step[name] = turn
    joined = " ".join(f"join {x}_{step[x]} using ({x})" for x in DIMENSIONS)
    product = " * ".join(f"{x}_factor" for x in DIMENSIONS)
    out += [
        f"fitted as (select source as _source, lang as _lang, topic as _topic, round(case when"
        f" base > 0 then least(1, {product}) else {mix.share}::double end, 9) as probability"
        f" from cells {joined})",
        "mixed as (select *, ('0x' || substr(md5(concat('" + mix.seed + ":', coalesce("
        "doc_id::varchar, ''))), 1, 8))::bigint / 4294967296::double < probability as kept"
        " from featured join fitted using (_source, _lang, _topic))",
    ]
    return ",\n".join(out)


#: Records of pages: the digest's hexadecimal digits are turned to base32 five at a time.
CAPTURES = """
with paid as (
    select page_id, encode(coalesce(html, '')) as payload from pages
), hashed as (
    select page_id, octet_length(payload) as payload_bytes, sha1(payload) as digest from paid
), newest as (
    select digest, max(page_id) as newest from hashed group by all
)
select page_id, payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(digest, (1 + 5 * (i // 4))::bigint, 5))::bigint
        >> (15 - 5 * (i % 4))::bigint) & 31) + 1, 1)), 'string_agg', '') as payload_digest,
    case when page_id is distinct from newest then 'revisit' else 'response' end as record_type,
    case when page_id is distinct from newest then newest end as refers_to
from hashed join newest using (digest)
"""


#: Trees level by level: ``up`` tells each leaf's node and its siblings at every level below the root.
#: A tree over the groups' roots follows in the same way.
MANIFEST = """
with recursive bits as (
    select i as b, i as v, 0 as step from range(256) t(i)
    union all
    select b, xor(v >> 1, case when v & 1 = 1 then 3988292384 else 0 end), step + 1 from bits
    where step < 8
), crcs as (
    select list(v order by b) as crc_of from bits where step = 8
), told as (
    select doc_id, lang, {fields} as told, {lowered} as lowered,
        xor(list_reduce(list_concat([4294967295::bigint],
            list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
            lambda y, x: xor(y >> 8, crc_of[(xor(y, x) & 255) + 1])), 4294967295) as crc
    from documents cross join crcs
), leaves as (
    select row_number() over () as rid, doc_id, lang, sha256(told) as leaf,
        case when crc % 3 = 0 then sha256(lowered) else sha256(told) end as present
    from told
), ranked as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
        count(*) over (partition by lang) as n
    from leaves
), nodes as (
    select lang, 0 as level, place, n, leaf as digest from ranked
    union all
    select lang, level + 1, place // 8, (any_value(n) + 7) // 8,
        sha256(string_agg(digest, '' order by place))
    from nodes where n > 1 group by lang, level, place // 8
), sides as (
    select a.lang, a.level, a.place,
        coalesce(string_agg(b.digest, '' order by b.place) filter (b.place < a.place), '') as before,
        coalesce(string_agg(b.digest, '' order by b.place) filter (b.place > a.place), '') as after
    from nodes a join nodes b on a.lang is not distinct from b.lang and a.level = b.level
        and a.place // 8 = b.place // 8
    where a.n > 1 group by all
), subroots as (
    select lang, digest as subroot, row_number() over (order by lang nulls first) - 1 as place,
        count(*) over () as n
    from nodes where n = 1
), tops as (
    select 0 as level, place, n, subroot as digest from subroots
    union all
    select level + 1, place // 8, (any_value(n) + 7) // 8,
        sha256(string_agg(digest, '' order by place))
    from tops where n > 1 group by level, place // 8
), top_sides as (
    select a.level, a.place,
        coalesce(string_agg(b.digest, '' order by b.place) filter (b.place < a.place), '') as before,
        coalesce(string_agg(b.digest, '' order by b.place) filter (b.place > a.place), '') as after
    from tops a join tops b on a.level = b.level and a.place // 8 = b.place // 8
    where a.n > 1 group by all
), steps as (
    select r.rid, s.level, s.before, s.after from ranked r join sides s
        on r.lang is not distinct from s.lang and s.place = r.place // (8 ** s.level)::bigint
    union all
    select r.rid, 1000 + t.level, t.before, t.after from ranked r join subroots g
        on r.lang is not distinct from g.lang
        join top_sides t on t.place = g.place // (8 ** t.level)::bigint
), paths as (
    select rid, list({{'before': before, 'after': after}} order by level) as path from steps
    group by rid
), folds as (
    select rid, present as digest, 1 as i from leaves
    union all
    select f.rid, sha256(path[i].before || digest || path[i].after), i + 1
    from folds f join paths using (rid) where i <= len(path)
)
select doc_id, leaf, subroot, root,
    sha256(coalesce(array_to_string(list_transform(path, lambda x: x.before || x.after), ''), ''))
        as proof_sha256,
    f.digest as folded_root, f.digest = root as verified
from leaves cross join (select digest as root from tops where n = 1)
join subroots on leaves.lang is not distinct from subroots.lang
left join paths using (rid) join folds f using (rid) where f.i = coalesce(len(path), 0) + 1
"""


def manifest() -> str:
    """The manifest of ``documents``."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = ["doc_id::varchar", "source", "lang", "n_chars::varchar", "text"]

    def told(values: list[str]) -> str:
        return " || ".join(
            f"coalesce(octet_length(encode({x}))::varchar || ':' || {x}, '-')" for x in values
        )

    return MANIFEST.format(fields=told(parts), lowered=told([*parts[:-1], lowered]))


def statistics(docs: str) -> list[str]:
    """CTEs that end in ``base``: the statistics of each row of ``docs``."""
    return [
        f"split as materialized (select row_number() over () as rid, *, {WORDS} as words,"
        " list_filter(string_split(coalesce(text, ''), chr(10)), lambda x:"
        f" regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from {docs})",
        "windows as (select rid, i, list_slice(words, i, i + 2) as three from (select rid, words,"
        " unnest(range(1, len(words) - 1)) as i from split))",
        "again as (select rid, i from (select *, count(*) over (partition by rid, three) as times"
        " from windows) where times > 1)",
        "covered as (select rid, count(distinct place) as n from (select rid,"
        " unnest([i, i + 1, i + 2]) as place from again) group by rid)",
        "base as (select *, len(words) as n_words,"
        " coalesce(length(list_aggregate(words, 'string_agg', '')), 0) as word_chars,"
        f" {_removed('#*$%&|<>')} as n_symbols, {_removed('A-Z')} as n_capitals,"
        " len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,"
        " coalesce(n, 0) as n_repeat_words from split left join covered using (rid))",
    ]


def outliers(docs: str, limits: Limits = Limits()) -> str:
    """CTEs that end in ``judged``: the rows of ``docs`` with statistics and verdicts."""
    n = range(5)
    pairs = [(i, j) for i in n for j in range(i + 1)]
    out = statistics(docs) + [
        "vectors as materialized (select *, coalesce(lang, '') as l, coalesce(source, '') as s,"
        f" n_words < {limits.least_words} or 100 * n_repeat_words >"
        f" {limits.most_repeat_percent} * n_words as base_failed,"
        " ln(greatest(word_chars, 1)::double / greatest(n_words, 1)) as v0,"
        " sqrt(n_symbols::double / greatest(word_chars, 1)) as v1,"
        " sqrt(n_dup_lines::double / greatest(n_lines, 1)) as v2,"
        " sqrt(n_repeat_words::double / greatest(n_words, 1)) as v3,"
        " sqrt(n_capitals::double / greatest(word_chars, 1)) as v4 from base)",
        "sizes as (select l, s, count(*) as size from vectors where not base_failed group by all)",
        f"pools as (select l, s, case when size >= {limits.least_pool} then 'source' || chr(1) || l"
        f" || chr(1) || s when sum(case when size < {limits.least_pool} then size else 0 end)"
        f" over (partition by l) >= {limits.least_pool} then 'language' || chr(1) || l"
        " else 'rest' end as pool from sizes)",
        "sound as materialized (select pool, v0, v1, v2, v3, v4 from vectors join pools"
        " using (l, s) where not base_failed)",
        "quartiles as (select pool, "
        + ", ".join(
            f"quantile_cont(round(v{i}, 3), {q}) as q{i}_{k}"
            for i in n
            for k, q in enumerate((0.25, 0.5, 0.75))
        )
        + " from sound group by pool)",
    ]
    squares = [
        f"pow((v{i} - q{i}_1) / ((q{i}_2 - q{i}_0) / 1.349::double + {limits.floors[i]}::double),"
        " 2)"
        for i in n
    ]
    out += [
        f"started as (select *, {' + '.join(squares)} as e0, greatest({', '.join(squares)}) as e1"
        " from sound join quartiles using (pool))",
        "near_0 as (select pool, v0, v1, v2, v3, v4, 0 as start, e0 as d from started union all"
        " select pool, v0, v1, v2, v3, v4, 1, e1 from started)",
    ]
    distance = " + ".join(
        "pow(" + " + ".join(f"w{i}_{j} * (v{j} - m{j})" for j in range(i + 1)) + ", 2)" for i in n
    )

    def reach(name: str, rows: str) -> list[str]:
        return [
            f"{name}_counts as (select pool, start, floor(log2(d + 1e-9::double) * 64)::int as bin,"
            f" count(*) as size from {rows} group by all)",
            f"{name} as materialized (select pool, start, min(bin) as last, any_value(whole) as"
            " pool_rows from (select *, sum(size) over (partition by pool, start order by bin) as"
            f" upto, sum(size) over (partition by pool, start) as whole from {name}_counts)"
            f" where upto >= ceil(whole * {limits.coverage}::double) group by all)",
        ]

    for step in range(limits.steps + 1):
        out += reach(f"reach_{step}", f"near_{step}")
        averages = [f"avg(v{i}) as m{i}" for i in n] + [
            f"avg(v{i} * v{j}) as p{i}_{j}" for i, j in pairs
        ]
        root, inverse = [], []
        for i, j in pairs:
            value = f"p{i}_{j} - m{i} * m{j}"
            value += f" + {limits.floors[i] ** 2!r}::double" if i == j else ""
            value += "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
            root.append(f"{f'sqrt({value})' if i == j else f'({value}) / l{j}_{j}'} as l{i}_{j}")
        for j in n:
            for i in range(j, 5):
                told = " + ".join(f"l{i}_{k} * w{k}_{j}" for k in range(j, i)) or "0"
                inverse.append(f"({int(i == j)} - ({told})) / l{i}_{i} as w{i}_{j}")
        out += [
            f"sums_{step} as (select pool, start, any_value(pool_rows) as pool_rows,"
            f" {', '.join(averages)} from near_{step} join reach_{step} using (pool, start)"
            " where floor(log2(d + 1e-9::double) * 64) <= last group by all)",
            f"fit_{step} as materialized (select *, {', '.join(root + inverse)},"
            f" {' * '.join(f'l{i}_{i}' for i in n)} as det from sums_{step})",
            f"near_{step + 1} as (select sound.*, start, {distance} as d from sound"
            f" join fit_{step} using (pool))",
        ]
    last = limits.steps
    out += [
        f"best as materialized (select * from fit_{last} qualify row_number() over"
        " (partition by pool order by det, start) = 1)",
        f"final as (select sound.*, start, {distance} as d from sound join best using (pool))",
        *reach("reach_final", "final"),
        "scaled as (select best.*, greatest(1, pow(2::double, (last + 1)::double / 64) /"
        f" {limits.chi_coverage}::double) as factor from best join reach_final using (pool, start)"
        f" where best.pool_rows >= {limits.least_pool})",
        f"judged as (select vectors.*, not base_failed and coalesce(({distance}) / factor <="
        f" {limits.cutoff}::double, true) as kept from vectors left join pools using (l, s)"
        " left join scaled using (pool))",
    ]
    return ",\n".join(out)


def oracle_sql() -> dict[str, str]:
    return {
        "op7_captures": CAPTURES,
        "op9_quality_outliers": f"with {outliers('documents')}\nselect doc_id, n_words, word_chars,"
        " n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged",
        "op12_merkle_manifest": manifest(),
        "op8_mixing": f"with {mixing('documents')}\nselect doc_id, _tokens as n_tokens,"
        " _topic as topic, probability, kept from mixed",
    }
