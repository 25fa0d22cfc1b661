"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tabloom.llm import divergence_rules

ANSWERS = r"""
with t as (
    select conv_id, coalesce(role, '') as role, coalesce("text", '') as "text",
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce("text", '')) as i
    from conversations
), ends as (
    select conv_id, max(i) as n, max(i) filter (role = 'assistant') as k from t group by conv_id
), answer as (
    select t.conv_id, t."text" from t join ends on t.conv_id = ends.conv_id and t.i = ends.k
), pair as (
    select e.conv_id, coalesce(e.k, e.n) as upto, a."text" as own, b."text" as other,
           e.k is not null and b.conv_id is not null as usable
    from ends e left join answer a on a.conv_id = e.conv_id left join answer b on b.conv_id = xor(e.conv_id, 1)
), cut as (
    select *, case when not usable then 0 when own = other then upto else upto - 1 end as shared from pair
), shown as (
    select c.conv_id, t.i, t.role, '<|' || t.role || '|>' || chr(10) as head, t."text" || '<|end|>' || chr(10) as body, c.shared, c.upto
    from cut c join t on t.conv_id = c.conv_id and t.i <= c.upto
), placed as (
    select *, sum(length(head) + length(body)) filter (i > shared) over (partition by conv_id order by i) as stop from shown
), sides as (
    select conv_id,
           coalesce(string_agg(head || body, '' order by i) filter (i <= shared), '') as prompt,
           coalesce(string_agg(head || body, '' order by i) filter (i > shared), '') as chosen,
           coalesce(string_agg((stop - length(body))::bigint || '-' || stop::bigint, ',' order by i)
                    filter (i > shared and role = 'assistant'), '') as chosen_spans
    from placed group by conv_id
)
select c.conv_id, s.prompt, c.shared::int as prompt_turns, s.chosen, s.chosen_spans,
       case when usable and own <> other then '<|assistant|>' || chr(10) || other || '<|end|>' || chr(10) else '' end as rejected,
       case when usable and own <> other then '14-' || (14 + length(other) + 8) else '' end as rejected_spans
from cut c join sides s on s.conv_id = c.conv_id
"""

DIGESTS = """
with d as (
    select doc_id, sha256(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
    from documents
), g as (
    select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by text_sha256
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
"""


def _distance(pairs: list[tuple[str, float]]) -> str:
    terms = (
        f"(case when {p} > 0 then {p} * log2(2 * {p} / ({p} + {q!r}::double)) else 0.0 end"
        f" + {q!r}::double * log2({2 * q!r}::double / ({p} + {q!r}::double))) / 2"
        for p, q in pairs
    )
    return f"sqrt(greatest({' + '.join(terms)}, 0.0))"


def _rules() -> str:
    limits = divergence_rules.Limits()
    languages = divergence_rules.COMMON_WORDS
    every = sorted({w for listed in languages.values() for w in listed})
    place = {w: f"w{i}" for i, w in enumerate(every)}
    counted = ", ".join(f"len(list_filter(bare, lambda w: w = '{w}')) / n::double as {place[w]}" for w in every)

    def to_language(listed: list[str]) -> str:
        pairs = [(place[w], divergence_rules.zipf(r)) for r, w in enumerate(listed, 1)]
        rest = "greatest(1.0 - (" + " + ".join(p for p, _ in pairs) + "), 0.0)"
        return _distance([*pairs, (rest, 1 - sum(q for _, q in pairs))])

    def beyond(part: float) -> tuple[str, str]:
        return (
            f"(word_chars >= {limits.least_characters} and from_characters > {part * limits.characters!r}::double)",
            f"(n_words >= {limits.least_words} and from_words > {part * limits.words!r}::double)",
        )

    characters = _distance([(f"c_{n}", q) for n, q in divergence_rules.CHARACTER_SHARES.items()])
    words = f"least({', '.join(to_language(listed) for listed in languages.values())})"
    return rf"""
with d as (
    select doc_id, coalesce("text", '') as t,
           regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as words from documents
), w as (
    select *, [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)] as wins,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from d
), pos as (
    select doc_id, unnest(wins) as win, unnest(range(1, len(wins) + 1)) as i from w
), seen as (
    select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as n from pos) where n > 1
), repeated as (
    select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i + 1, i + 2]) as j from seen) group by doc_id
), base as (
    select w.doc_id, len(words)::bigint as n_words, length(array_to_string(words, '')) as word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
           greatest(len(words), 1) as n, greatest(length(array_to_string(words, '')), 1)::double as held, t,
           list_transform(words, lambda x: lower(trim(x, '.,;:!?''"()'))) as bare
    from w left join repeated r on r.doc_id = w.doc_id
), shares as (
    select *, length(regexp_replace(t, '[^\p{{Ll}}]+', '', 'g')) / held as c_lower,
           length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) / held as c_upper,
           length(regexp_replace(t, '[^0-9]+', '', 'g')) / held as c_digit,
           length(regexp_replace(t, '[^.,;:!?''"()\-]+', '', 'g')) / held as c_punctuation,
           {counted}
    from base
), judged as (
    select *, greatest(1.0 - (c_lower + c_upper + c_digit + c_punctuation), 0.0) as c_other from shares
), far as (
    select *, {characters} as from_characters, {words} as from_words,
           n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
    from judged
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not ({beyond(1.0)[0]} or {beyond(1.0)[1]} or ({' and '.join(beyond(limits.jointly))})) as kept
from far
"""


RULES = _rules()

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED = f"""
with read as (select doc_id, {_TERMS} as terms from documents),
     sizes as (select count(*) as n_docs, sum(len(terms)) as n_terms from read where len(terms) > 0),
     items as (select item_id, term, count(*) as times
               from (select item_id, unnest({_TERMS}) as term from benchmark) t group by item_id, term),
     held as (select doc_id, term, n, count(*) as tf
              from (select doc_id, len(terms) as n, unnest(terms) as term from read) t
              where term in (select term from items) group by doc_id, term, n),
     weights as (select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
                 from held, sizes group by term, n_docs),
     impacts as (select doc_id, term,
                        w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) as impact
                 from held join weights using (term), sizes),
     scores as (select item_id, doc_id, cast(sum(times * impact) as bigint) as score
                from items join impacts using (term) group by item_id, doc_id having sum(times * impact) > 0),
     ranked as (select item_id, doc_id, score,
                       cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
                from scores)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""
