"""DuckDB SQL of the operators whose results SQL can express, over whole tables."""

from __future__ import annotations

from .chat import CONTROLS, MARKERS
from .mixing import DEFAULT_SEED
from .pii import AGAINST, IBAN_LENGTHS, WORDS

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_COMPONENTS = """ways AS (SELECT a AS x, b AS y FROM pairs UNION SELECT b, a FROM pairs),
 reach AS (SELECT x, y FROM ways UNION SELECT r.x, w.y FROM reach r JOIN ways w ON r.y = w.x),
 least AS (SELECT x, least(x, min(y)) AS component FROM reach GROUP BY x)"""

NEAR_DEDUP = f"""WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
 shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split)),
 sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
 common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id > y.doc_id GROUP BY 1, 2),
 pairs AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)), {_COMPONENTS}
 SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id, d.doc_id = coalesce(component, d.doc_id) AS kept FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON least.x = d.doc_id"""

SUBSTRING_DEDUP = f"""WITH split AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
 wins AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM split WHERE len(w) >= 20)),
 later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM wins) WHERE n > 1),
 gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(p, p + 20)) AS i FROM later)),
 each AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM split),
 marked AS (SELECT e.doc_id, e.t, e.i, g.i IS NOT NULL AS out FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i)
 SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, coalesce(m.r, 0) AS n_removed, sha256(coalesce(m.k, '')) AS kept_sha256 FROM split s LEFT JOIN (
 SELECT doc_id, count(*) FILTER (WHERE out) AS r, string_agg(t, ' ' ORDER BY i) FILTER (WHERE NOT out) AS k FROM marked GROUP BY doc_id) m ON m.doc_id = s.doc_id"""


def _in_text(column: str) -> str:
    """Occurrences of control strings, with or without backslashes: each gets one more."""
    quoted = lambda s: "".join(f"[{c}]" if c in "|[/" else ("[]]" if c == "]" else c) for c in s)
    pattern = "|".join(f"{quoted(c[0])}\\\\*{quoted(c[1:])}" for c in CONTROLS)
    return f"len({column}) + len(regexp_extract_all({column}, '{pattern}'))"


_MARKS = sum(map(len, MARKERS.values()))
CHAT = f"""WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
 CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum({_in_text('role')} + {_in_text('text')} + {_MARKS}) AS BIGINT) AS formatted_chars FROM said GROUP BY conv_id"""


def _hash(salt: int) -> str:
    return f"CAST(concat('0x', left(md5(concat('{salt}:', CAST(doc_id AS STRING))), 12)) AS BIGINT)"


MIXING = f"""WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS size FROM documents),
 sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS rows, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM sized GROUP BY source),
 ordered AS (SELECT *, 2.0::DOUBLE * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total, coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS clipped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS n FROM sources
 WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 level AS (SELECT arg_min((total - clipped) / free, n) FILTER (WHERE weight * ((total - clipped) / free) <= cap) AS level FROM ordered),
 plan AS (SELECT o.source, source_size, rows, least(cap, weight * level) AS target FROM ordered o, level),
 dealt AS (SELECT s.doc_id, s.size, p.source, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS epochs, {_hash(DEFAULT_SEED)} AS h, {_hash(DEFAULT_SEED + 1)} % CAST(ceil(p.rows / 256.0) AS BIGINT) AS stratum FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
 counted AS (SELECT *, sum(size) OVER (PARTITION BY source, stratum) * (epochs - floor(epochs)) AS part, sum(size) OVER (PARTITION BY source, stratum ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS until FROM dealt)
 SELECT doc_id, size, source_size, target, size * times AS taken, times FROM (SELECT *, CAST(floor(epochs) + CASE WHEN until <= part AND epochs > floor(epochs) THEN 1 ELSE 0 END AS INT) AS times FROM counted)"""

TOP_K = """WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
 SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored) WHERE n <= 5"""

NEAR_VECTORS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 n AS (SELECT *, sqrt(list_inner_product(e, e)) AS m FROM v WHERE list_inner_product(e, e) > 0),
 pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.label = y.label AND x.vec_id > y.vec_id WHERE list_inner_product(x.e, y.e) / (x.m * y.m) >= 0.98), {_COMPONENTS},
 degree AS (SELECT x, count(*) AS d FROM ways GROUP BY x)
 SELECT vec_id, coalesce(d, 0) AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept FROM embeddings LEFT JOIN degree ON degree.x = vec_id LEFT JOIN least ON least.x = vec_id"""

# crc32 by its table of 256 entries, made from the polynomial
_CRC_TABLE = """bits AS (SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
 crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8)"""


def _crc32(text: str) -> str:
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"


def _edit(way: str, cost: str, letter: str, said: str = "") -> str:
    """A way (cost, edits, turns) with one more edit; null where there is none."""
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}', 'o': {way}.o{said and ' || chr(10) || ' + said}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _role_edits(way: str, initial: str, role: str) -> str:
    return f"CASE WHEN NOT gone AND initial = '{initial}' THEN {_edit(way, 'more', 'K', 'role || chr(58) || text')} END, CASE WHEN NOT gone THEN {_edit(way, '3 + more', 'R', f"'{role}:' || text")} END"


_SPACE = "coalesce(CAST({0} AS VARCHAR), ' ')".format
_WAY = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
REPAIR = f"""WITH RECURSIVE {_CRC_TABLE},
 hashed AS (SELECT conv_id, turn, {_SPACE('role')} AS role, {_SPACE('text')} AS text, {_crc32(f"{_SPACE('conv_id')} || ':' || {_SPACE('turn')}")} % 20 AS kind FROM conversations, crc),
 damaged AS (SELECT *, row_number() OVER () AS copy FROM (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS second FROM hashed WHERE kind <> 0)),
 placed AS (SELECT *, row_number() OVER w AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, left(lag(role) OVER w, 1) || left(role, 1) AS pair, left(role, 1) AS initial,
 NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
 faults AS (SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS more FROM placed),
 walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, CAST({{'c': 0, 'a': '', 'o': ''}} AS {_WAY}) AS n, CAST(NULL AS {_WAY}) AS s, CAST({{'c': 3, 'a': 'I', 'o': chr(10) || 'user:'}} AS {_WAY}) AS u, CAST({{'c': 6, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS {_WAY}) AS a FROM (SELECT DISTINCT conv_id FROM faults)
 UNION ALL SELECT conv_id, pos, n, s, u, {_least('a', _edit('u', '3', 'I', "'assistant:'"))} FROM (
 SELECT conv_id, pos, n, s, {_least('u', _edit('n', '3', 'I', "'user:'"), _edit('s', '3', 'I', "'user:'"), _edit('a', '3', 'I', "'user:'"))} AS u, a FROM (
 SELECT w.conv_id, f.pos, {_edit('w.n', '4', 'D')} AS n, {_least(_edit('w.s', '4', 'D'), f"CASE WHEN NOT gone AND initial = 's' THEN {_edit('w.n', 'more', 'K', 'role || chr(58) || text')} END")} AS s,
 {_least(_edit('w.u', '4', 'D'), *[_role_edits(w, 'u', 'user') for w in ('w.n', 'w.s', 'w.a')])} AS u, {_least(_edit('w.a', '4', 'D'), _role_edits('w.u', 'a', 'assistant'))} AS a
 FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1))),
 done AS (SELECT conv_id, arg_max({_least('n', 'a')}, pos) AS way FROM walk GROUP BY conv_id),
 counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE more > 0) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
 SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.c, 0) AS cost, coalesce(way.a, '') AS audit, sha256(coalesce(substr(way.o, 2), '')) AS repaired_sha256
 FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM o.conv_id"""

_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split({_DIGITS}, ''), lambda c, i: CASE WHEN (len({_DIGITS}) - i) % 2 = 1 THEN 2 * CAST(c AS INT) - CASE WHEN c > '4' THEN 9 ELSE 0 END ELSE CAST(c AS INT) END)) % 10 = 0"
_PLAIN = "regexp_replace(hit, '[ -]', '', 'g')"
_MOD_97 = f"""list_reduce(list_prepend(0, list_transform(string_split(substr({_PLAIN}, 5) || left({_PLAIN}, 4), ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda r, d: (CASE WHEN d >= 10 THEN r * 100 ELSE r * 10 END + d) % 97) = 1"""
_ALONE = "NOT regexp_matches(right(before, 1), '{0}') AND NOT regexp_matches(left(after, 1), '{0}') AND (i = 1 OR before <> '')".format
_IBAN_PLAIN = "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
# the contract's patterns as they stand there, and those of the added kinds
_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(hit, '.'), lambda p: TRY_CAST(p AS DOUBLE))) <= 255"),
    "card": (r"[0-9]([\x20-]?[0-9])+", f"len({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"len({_DIGITS}) BETWEEN 10 AND 15"),
    "iban": (_IBAN_PLAIN, f"{_MOD_97} AND {_ALONE('[A-Za-z0-9]')}"),
    "ssn": ("[0-9]{3}-[0-9]{2}-[0-9]{4}", f"NOT regexp_matches(hit, '^(000|666|9)|-00-|-0000$') AND {_ALONE('[A-Za-z0-9-]')} AND said AND NOT against"),
    "tel": (r"[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}", f"NOT regexp_matches(hit, '^[(][0-9]{{3}}[^)]|^[0-9]{{3}}[)]') AND {_ALONE('[A-Za-z0-9-]')} AND said AND NOT against"),
}


def _matches(number: int, kind: str, pattern: str, valid: str) -> str:
    near = "translate(right(before, 48) || ' ' || left(after, 24), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    says = lambda words: f"regexp_matches({near}, '(?:^|[^a-z])(?:{words})(?:[^a-z]|$)')"
    cut = f"SELECT row, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS pieces FROM numbered"
    each = f"SELECT row, unnest(range(1, len(hits) + 1)) AS i, hits, pieces FROM ({cut})"
    named = f"SELECT row, i, hits[i] AS hit, pieces[i] AS before, pieces[i + 1] AS after FROM ({each})"
    ends = f"SELECT *, sum(len(before) + len(hit)) OVER (PARTITION BY row ORDER BY i) AS upto, {says(WORDS[kind])} AS said, {says(AGAINST)} AS against FROM ({named})"
    return f"SELECT row, {number} AS number, '{kind}' AS kind, CAST(upto - len(hit) AS BIGINT) AS begins, CAST(upto AS BIGINT) AS ends FROM ({ends}) WHERE {valid}"


_LISTED = "coalesce(string_agg(kind || ':' || begins || ':' || ends, ',' ORDER BY begins, number){0}, '')".format
PII = f"""WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
 spans AS ({' UNION ALL '.join(_matches(n, kind, *how) for n, (kind, how) in enumerate(_KINDS.items()))})
 SELECT n.doc_id, {', '.join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in ('email', 'ip', 'card', 'phone'))}, sha256({_LISTED(' FILTER (WHERE number < 4)')}) AS base_sha256, {_LISTED('')} AS spans, count(*) FILTER (WHERE number >= 4) AS n_added
 FROM numbered n LEFT JOIN spans s ON s.row = n.row GROUP BY n.row, n.doc_id"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
RANK = f"""WITH said AS (SELECT doc_id, row, unnest(t) AS term, len(t) AS n FROM (SELECT doc_id, row_number() OVER () AS row, {_TERMS} AS t FROM documents)),
 tf AS (SELECT doc_id, row, term, CAST(n AS BIGINT) AS n, count(*) AS tf FROM said GROUP BY ALL),
 whole AS (SELECT CAST(count(DISTINCT row) AS BIGINT) AS docs, count(*) AS terms FROM said),
 df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
 asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
 scored AS (SELECT item_id, row, doc_id, CAST(sum(CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score FROM asked JOIN df USING (term) JOIN tf USING (term), whole GROUP BY item_id, row, doc_id)
 SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""

ORACLES = {
    "op2_near_dedup": NEAR_DEDUP, "op3_substring_dedup": SUBSTRING_DEDUP, "op5_chat_format": CHAT, "op6_mixing": MIXING, "op7_exact_top_k": TOP_K, "op8_near_vectors": NEAR_VECTORS,
    "op11_structure_repair": REPAIR, "op12_pii": PII, "op13_lexical_rank": RANK,
}
