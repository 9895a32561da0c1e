"""The results of the operators that SQL can express, in DuckDB SQL over the given tables."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEXICAL = rf"""
with words as (
  select doc_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
), held as (select doc_id, term, count(*) as tf from words group by all
), sizes as (select doc_id, count(*) as n from words group by all
), total as (select count(*) as docs, sum(n)::bigint as length from sizes
), weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from held, total group by term
), asked as (
  select item_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::bigint as score
  from asked join held using (term) join weights using (term) join sizes using (doc_id), total group by all
), ranked as (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank, doc_id, score from scored where score > 0
)
select * from ranked where rank <= 20
"""

COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents
), worded as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), grams as (
  select lang, k, array_to_string(w[s : s + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as s from worded, generate_series(1, 5) as widths(k) where len(w) >= k)
), counts as (select lang, k, phrase, count(*) as c from grams group by all
), totals as (select lang, sum(c)::bigint as n from counts where k = 1 group by lang
), candidates as (select lang, k, phrase, string_split(phrase, ' ') as w, c as a, n from counts join totals using (lang) where k > 1 and c >= 100
), cuts as (
  select *, array_to_string(w[1:cut], ' ') as head, array_to_string(w[cut + 1 : k], ' ') as tail
  from (select *, unnest(generate_series(1, k - 1)) as cut from candidates)
), scored as (
  select cuts.lang, cuts.phrase, a, n, cut, h.c as l, t.c as r, (1000::hugeint * a * n) // (h.c::hugeint * t.c) as score
  from cuts join counts h on h.lang = cuts.lang and h.phrase = head join counts t on t.lang = cuts.lang and t.phrase = tail
), best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), inner_phrases as (
  select distinct lang, a, array_to_string(w[s : s + m - 1], ' ') as phrase
  from (select *, unnest(generate_series(1, k - m + 1)) as s from candidates, generate_series(2, 4) as widths(m) where m < k)
), kept as (select * from best where not exists (
  select 1 from inner_phrases i where i.lang = best.lang and i.phrase = best.phrase and 100 * i.a >= 100 * best.a)
), ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score from kept)
select * from ranked where rank <= 2000
"""

ORACLES = {"op12_lexical": LEXICAL, "op13_collocations": COLLOCATIONS}
