"""SQL for DuckDB that gives the rows of operators over the given tables, written apart from the operators."""

from __future__ import annotations

from carebundle.llm import license_scan, target_sampling

# Words of digits, letters and everything beyond ASCII, with A-Z in lower case.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def similar_components_sql(width: int, percent: int) -> str:
    """Shingles that two documents share, links among them, and the smallest document that links lead to."""
    shingle = " || ' ' || ".join(f"words[i + {k}]" for k in range(width))
    return rf"""
        with recursive rows as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^ 	-]+') as words from documents),
        sets as (
            select doc_id, list_distinct(case when len(words) >= {width}
                then list_transform(range(1, len(words) - {width - 2}), lambda i: {shingle})
                when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as shingles from rows),
        shingle as (select doc_id, unnest(shingles) as shingle from sets),
        shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as n
            from shingle a join shingle b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
        link as (
            select a, b from shared join sets x on a = x.doc_id join sets y on b = y.doc_id
            where 100 * n >= {percent} * (len(x.shingles) + len(y.shingles) - n)),
        edge as (select a, b from link union all select b, a from link),
        reached as (select doc_id as a, doc_id as b from sets union select r.a, s.b from reached r join edge s on r.b = s.a)
        select doc_id, len(shingles)::bigint as n_shingles, component_id
        from sets join (select a as doc_id, min(b) as component_id from reached group by a) using (doc_id)"""


def license_scan_sql() -> str:
    """Joins of words with the templates: rare words by document counts, votes for beginnings, phrases and words around."""
    settings = license_scan.Settings()
    template_rows, phrase_rows, meta_rows = [], [], []
    for number, template in enumerate(license_scan.TEMPLATES):
        own = license_scan.template_words(template.text)
        looked_up = license_scan.index_size(own, settings)
        meta_rows.append(f"({number}, {_text(template.label)}, {len(own)}, {len(set(own))}, {looked_up})")
        template_rows += [f"({number}, {place}, {_text(word)})" for place, word in enumerate(own)]
        phrase_rows += [f"({number}, {_text(' ' + phrase + ' ')})" for phrase in template.phrases]
    base_rows = [f"({_text(phrase)}, {len(phrase.split())}, {_text(label)})" for phrase, label in license_scan.BASE_PHRASES]
    return rf"""
        with rows as (select doc_id, {_WORDS} as words from documents),
        template_word(t, p, word) as (values {", ".join(template_rows)}),
        template(t, label, n, n_distinct, looked_up) as (values {", ".join(meta_rows)}),
        phrase(t, phrase) as (values {", ".join(phrase_rows)}),
        base(phrase, n, label) as (values {", ".join(base_rows)}),
        word_at as (select doc_id, unnest(words) as word, unnest(range(len(words))) as i from rows),
        named as (select doc_id, word, i from word_at where word in (select word from template_word)),
        frequency as (select word, count(distinct doc_id) as df from named group by word),
        ranked as (
            select t, word, row_number() over (partition by t order by coalesce(df, 0), first_p) as rank
            from (select t, word, min(p) as first_p from template_word group by t, word) left join frequency using (word)),
        votes as (
            select doc_id, t, i - p as begins, word
            from ranked join template using (t) join template_word using (t, word) join named using (word)
            where rank <= looked_up),
        candidate as (
            select doc_id, t, begins from votes group by doc_id, t, begins having count(distinct word) >= {settings.votes}),
        around as (
            select c.doc_id, c.t, c.begins, label, n_distinct,
                   words[greatest(c.begins - {settings.slack}, 0) + 1 : greatest(c.begins + n + {settings.slack}, 0)] as words
            from candidate c join template using (t) join rows using (doc_id)),
        shares as (
            select doc_id, label, begins, t,
                   (select count(distinct w.word) from template_word w where w.t = a.t and list_contains(a.words, w.word))
                   / n_distinct as share,
                   (select bool_and(contains(' ' || array_to_string(a.words, ' ') || ' ', f.phrase))
                    from phrase f where f.t = a.t) as whole
            from around a),
        verified as (select doc_id, label, share from shares where whole and share >= {settings.coverage}),
        base_at as (
            select doc_id, label, i from (
                select doc_id, i, word as w0, lead(word, 1) over f as w1, lead(word, 2) over f as w2
                from word_at window f as (partition by doc_id order by i)) x
            join base on base.phrase = case base.n when 2 then w0 || ' ' || w1 else w0 || ' ' || w1 || ' ' || w2 end),
        bases as (
            select doc_id, count(*) as n_base, min(i) as first_word, max(i) as last_word,
                   list_sort(list_distinct(list(label))) as labels from base_at group by doc_id),
        best as (
            select doc_id, max(share) as share, list_distinct(list(label)) as labels from verified group by doc_id)
        select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
               first_word::bigint as first_word, last_word::bigint as last_word,
               coalesce(array_to_string(bases.labels, ','), '') as base_labels,
               array_to_string(list_sort(list_distinct(list_concat(
                   coalesce(bases.labels, []), coalesce(best.labels, [])))), ',') as labels,
               coalesce(share, case when n_base > 0 then {settings.base_score} else 0 end)::double as score
        from rows left join bases using (doc_id) left join best using (doc_id)"""


def target_sampling_sql() -> str:
    """Buckets of distinct words by a table-driven CRC-32, gains, mean gains, noise and ranks."""
    s = target_sampling.Settings()
    return rf"""
        with crc_table as (
            select list(list_reduce(list_prepend(n::ubigint, list_transform(range(8), lambda x: 0::ubigint)),
                        lambda c, x: case when c & 1 = 1 then xor(3988292384::ubigint, c >> 1) else c >> 1 end) order by n) as t
            from range(256) r(n)),
        own as (select 0 as side, doc_id, {_WORDS} as words from documents),
        wanted as (select 1 as side, item_id as doc_id, {_WORDS} as words from benchmark),
        word_at as (
            select side, doc_id, unnest(words) as word from own union all select side, doc_id, unnest(words) from wanted),
        counted as (select side, doc_id, word, count(*) as n from word_at group by all),
        vocabulary as (
            select word, list_transform(range(octet_length(encode(word))),
                       lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::ubigint) as bytes
            from (select distinct word from counted)),
        bucketed as (
            select word, xor(list_reduce(list_prepend(4294967295::ubigint, bytes),
                       lambda c, b: xor(t[(xor(c, b) & 255)::bigint + 1], c >> 8)), 4294967295::ubigint)
                       % {s.buckets} as bucket
            from vocabulary, crc_table),
        totals as (
            select bucket, coalesce(sum(n) filter (where side = 0), 0) as s, coalesce(sum(n) filter (where side = 1), 0) as t
            from counted join bucketed using (word) group by bucket),
        whole as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from totals),
        gains as (
            select bucket, floor({s.scale} * ln(((t + 1)::double * (all_s + {s.buckets})::double)
                                 / ((s + 1)::double * (all_t + {s.buckets})::double)))::bigint as gain
            from totals, whole),
        weights as (
            select doc_id, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint as weight
            from counted join bucketed using (word) join gains using (bucket) where side = 0 group by doc_id),
        scored as (
            select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
                   ('0x' || substr(sha256('{s.seed}:' || doc_id), 1, 8))::ubigint as h
            from documents left join weights using (doc_id)),
        noisy as (
            select doc_id, n_features, weight,
                   (weight + floor(-{s.scale} * ln(-ln((h::double + 0.5) / 4294967296.0::double))))::bigint as score
            from scored),
        placed as (
            select doc_id, row_number() over (order by score desc, doc_id) as place from noisy where n_features >= {s.least_words})
        select doc_id, n_features, weight, score,
               case when place <= (select {s.percent} * count(*) // 100 from placed) then place end as rank
        from noisy left join placed using (doc_id)"""
