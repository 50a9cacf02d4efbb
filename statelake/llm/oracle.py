"""DuckDB SQL with the same result as the query of the same name, where SQL can express it.

Not here: extraction (a tree), language-model scores (a model), quality rules and SimHash (XXH64);
their tests compare with brute force.
"""

from statelake.llm import pii
from statelake.llm.license_texts import PHRASES, TEMPLATES
from statelake.llm.licenses import GRAM, LicenseRules
from statelake.llm.secrets import KINDS, SecretRules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _found(number: int, kind: str) -> str:
    pattern, group = KINDS[kind]
    quoted = pattern.replace("'", "''")
    return f"""
      SELECT doc_id, source, {number} AS kind, generate_subscripts(m, 1) AS i, m, g, p FROM (
        SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '{quoted}') AS m,
               regexp_extract_all(coalesce(text, ''), '{quoted}', {group}) AS g,
               list_transform(string_split_regex(coalesce(text, ''), '{quoted}'), lambda x: length(x)) AS p
        FROM documents) WHERE len(m) > 0"""


def _pii_points(kind: str) -> str:
    near = lambda words: f"regexp_matches(around, '(^|[^a-z])({words})([^a-z]|$)')"
    return (
        f"greatest(0, least(100, {pii.POINTS[kind]} + CASE WHEN {near(pii.CONTEXT[kind])} THEN {pii.SUPPORT} ELSE 0 END"
        f" - CASE WHEN {near(pii.AGAINST)} THEN {pii.CONTRARY} ELSE 0 END))"
    )


def _pii_test(kind: str) -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CAST(substr(CASE WHEN i % 2 = 1 THEN '0123456789'"
        f" ELSE '0246813579' END, CAST(substr(reverse({digits}), i, 1) AS INTEGER) + 1, 1) AS INTEGER))) % 10 = 0"
    )
    code = "replace(m, ' ', '')"
    turned = f"substr({code}, 5) || left({code}, 4)"
    each = f"list_transform(range(1, length({code}) + 1), lambda i: ascii(substr({turned}, i, 1)))"
    mod97 = f"list_reduce(list_prepend(0, {each}), lambda a, c: CASE WHEN c < 65 THEN a * 10 + c - 48 ELSE a * 100 + c - 55 END % 97) = 1"
    tests = {
        "email": "true",
        "ip": rf"regexp_matches(m, '^{pii.OCTET}(\.{pii.OCTET}){{3}}$')",
        "card": f"length({digits}) BETWEEN 16 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": f"length({code}) BETWEEN 15 AND 34 AND {mod97}",
        "shortcard": f"length({digits}) BETWEEN 13 AND 15 AND {luhn}",
    }
    added = f" AND apart AND {_pii_points(kind)} >= {pii.PiiRules.threshold}" if pii.ORDER.index(kind) >= pii.N_FIXED else ""
    return tests.get(kind, "true") + added


def _pii_found(name: str) -> str:
    kinds = [name, "shortcard"] if name == "card" else [name]
    pattern = pii.PATTERNS[name].replace("'", "''")
    number = "CASE " + " ".join(f"WHEN {_pii_test(k)} THEN {pii.ORDER.index(k)}" for k in kinds) + " END"
    points = "CASE " + " ".join(f"WHEN {_pii_test(k)} THEN {_pii_points(k)}" for k in kinds) + " END"
    w = pii.PiiRules.window
    return f"""
      SELECT doc_id, {list(pii.PATTERNS).index(name)} AS pattern, s, e, {number} AS kind, {points} AS points FROM (
        SELECT doc_id, m, s, e, translate(before || ' ' || after, '{_UPPER}', '{_LOWER}') AS around,
               NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AS apart FROM (
          SELECT doc_id, m[i] AS m, right(p[i], {w}) AS before, left(p[i + 1], {w}) AS after,
                 list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
                 list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e FROM (
            SELECT *, generate_subscripts(m, 1) AS i FROM (
              SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m, string_split_regex(coalesce(text, ''), '{pattern}') AS p
              FROM documents) WHERE len(m) > 0)))"""


OP2 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT doc_id, octet_length(b) AS n, hex(b) AS h FROM d),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM x WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS t FROM w) WHERE t > 1),
s AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER o + 100 OR lag(p) OVER o IS NULL THEN 1 ELSE 0 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
i AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM s),
q AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS e FROM i GROUP BY doc_id, run),
g AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f FROM q),
k AS (SELECT doc_id, sum(e - a) AS gone, count(*) AS runs, max(e) AS last,
             string_agg(substr(h, 2 * f + 1, 2 * (a - f)), '' ORDER BY a) AS kept FROM g JOIN x USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM x LEFT JOIN k USING (doc_id)
"""

OP4 = f"""
WITH raw AS ({" UNION ALL ".join(_found(k, kind) for k, kind in enumerate(KINDS))}),
spans AS (
  SELECT doc_id, source, kind, g[i] AS v, list_sum(p[1:i]) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
         list_sum(p[1:i]) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e FROM raw),
kept AS (
  SELECT *, max(CASE WHEN kind < 3 THEN e END) OVER (PARTITION BY doc_id ORDER BY s, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
  FROM spans WHERE (kind <> 0 OR length(v) >= 12)
    AND (kind < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT regexp_matches(v, '[0-9a-f]{{16}}|AKIA[A-Z0-9]{{14}}')))),
found AS (SELECT * FROM kept WHERE kind < 3 OR coalesce(reached, 0) <= s),
owned AS (
  SELECT v, count(DISTINCT CASE WHEN source IS NULL THEN '1' ELSE '0' || source END) <= {SecretRules.max_owners}
         AND count(DISTINCT concat(coalesce('0' || CAST(doc_id AS VARCHAR), '1'), ' ', coalesce('0' || source, '1'))) <= {SecretRules.max_repositories} AS live
  FROM found GROUP BY v),
named AS (
  SELECT doc_id, kind, live, s, concat_ws(':', ['assign', 'access', 'hex', 'generic'][kind + 1], CAST(CAST(s AS BIGINT) AS VARCHAR), CAST(CAST(e AS BIGINT) AS VARCHAR)) AS t
  FROM found JOIN owned USING (v) WHERE kind < 3 OR live),
rows AS (
  SELECT doc_id, count_if(kind = 0) AS a, count_if(kind = 1) AS c, count_if(kind = 2) AS h, count_if(live) AS l, count_if(NOT live) AS n,
         string_agg(CASE WHEN kind < 3 THEN t END, ',' ORDER BY s, kind) AS base, string_agg(t, ',' ORDER BY s, kind) AS everything
  FROM named GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access, CAST(coalesce(h, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(everything, '') AS spans,
       CAST(coalesce(l, 0) AS BIGINT) AS n_live, CAST(coalesce(n, 0) AS BIGINT) AS n_shared
FROM documents LEFT JOIN rows USING (doc_id)
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY src) - 1 AS k FROM d GROUP BY src),
w AS (
  SELECT *, CAST([3, 1, 2][k % 3 + 1] AS DOUBLE) AS weight, CAST([1.5, 1.0, 0.5][k % 3 + 1] AS DOUBLE) AS opens,
         CAST([0.5, 1.0, 1.5][k % 3 + 1] AS DOUBLE) AS closes, CAST(source_size * 2 AS DOUBLE) AS ceiling,
         CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS demand FROM s),
l AS (
  SELECT *, (demand - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
            sum(weight) OVER (ORDER BY ceiling / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
c AS (SELECT *, level * weight >= ceiling AS capped, max(CASE WHEN level * weight < ceiling THEN level END) OVER () AS shared FROM l),
t AS (SELECT src, source_size, opens, closes, CASE WHEN capped THEN ceiling ELSE shared * weight END AS target FROM c),
p AS (
  SELECT doc_id, size, source_size, target, opens, closes, CAST(floor(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t USING (src)),
m AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM p),
f AS (SELECT *, CAST(start AS DOUBLE) / budget AS part FROM m)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + least(greatest(budget - passes * source_size - start, 0), size) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND start < budget THEN
         CASE WHEN opens = closes THEN part
              ELSE (sqrt(opens * opens + 2 * (closes - opens) * part) - opens) / (closes - opens) + CAST(0.0 AS DOUBLE) END END AS position
FROM f
"""

OP9 = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, place.k AS k, i FROM place JOIN win ON place.k = win.k AND place.t = win.t),
word AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(v, ',' ORDER BY v) AS t
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(named.t, '')) AS items_sha256, coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n < 1000 OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < 1000 OR page_id = top THEN NULL ELSE top END AS refers_to
FROM q
"""

_PII_NAMES = ", ".join(f"'{k}'" for k in pii.ORDER)
OP11 = f"""
WITH found AS ({" UNION ALL ".join(_pii_found(name) for name in pii.PATTERNS)}),
placed AS (
  SELECT *, max(CASE WHEN kind < {pii.N_FIXED} THEN e END) OVER (PARTITION BY doc_id ORDER BY s, pattern ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
  FROM found WHERE kind IS NOT NULL),
named AS (
  SELECT *, concat_ws(':', [{_PII_NAMES}][kind + 1], CAST(CAST(s AS BIGINT) AS VARCHAR), CAST(CAST(e AS BIGINT) AS VARCHAR)) AS t
  FROM placed WHERE kind < {pii.N_FIXED} OR coalesce(reached, 0) <= s),
rows AS (
  SELECT doc_id, count_if(kind = 0) AS a, count_if(kind = 1) AS b, count_if(kind = 2) AS c, count_if(kind = 3) AS d,
         count_if(kind >= {pii.N_FIXED}) AS added, max(points) AS top,
         string_agg(CASE WHEN kind < {pii.N_FIXED} THEN t END, ',' ORDER BY kind, s) AS base, string_agg(t, ',' ORDER BY kind, s) AS everything
  FROM named GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_email, CAST(coalesce(b, 0) AS BIGINT) AS n_ip, CAST(coalesce(c, 0) AS BIGINT) AS n_card,
       CAST(coalesce(d, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(everything, '') AS spans,
       CAST(coalesce(added, 0) AS BIGINT) AS n_added, CAST(coalesce(top, 0) AS BIGINT) AS top_points
FROM documents LEFT JOIN rows USING (doc_id)
"""



def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bit = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {bit}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _level(tree: str, k: int) -> str:
    """Level k + 1 of a tree, and the siblings of every node of level k."""
    return f"""
{tree}{k + 1} AS (
  SELECT part, place // 16 AS place, CASE WHEN any_value(size) > 1 THEN sha256(string_agg(node, '' ORDER BY place)) ELSE any_value(node) END AS node,
         (any_value(size) + 15) // 16 AS size FROM {tree}{k} GROUP BY part, place // 16),
{tree}s{k} AS (
  SELECT part, place, size > 1 AS inner_node,
         coalesce(string_agg(node, '') OVER (PARTITION BY part, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (PARTITION BY part, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {tree}{k})"""


def _op12(levels: int = 6, top_levels: int = 4) -> str:
    head = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = lambda text: f"sha256({' || '.join([*head, _field(text)])})"
    steps = [("t", k) for k in range(levels)] + [("u", k) for k in range(top_levels)]
    folds, before = [], "altered"
    for i, (tree, k) in enumerate(steps):
        folds.append(f"f{i} AS (SELECT *, CASE WHEN {tree}{k}i THEN sha256({tree}{k}l || {before} || {tree}{k}r) ELSE {before} END AS h{i} FROM {'joined' if not i else f'f{i - 1}'})")
        before = f"h{i}"
    joins = "".join(f" JOIN ts{k} ON ts{k}.part = b.part AND ts{k}.place = b.place // {16 ** k}" for k in range(levels))
    joins += "".join(f" JOIN us{k} ON us{k}.place = p.place // {16 ** k}" for k in range(top_levels))
    columns = ", ".join(f"{t}s{k}.inner_node AS {t}{k}i, {t}s{k}.l AS {t}{k}l, {t}s{k}.r AS {t}{k}r" for t, k in steps)
    proof = " || ".join(f"CASE WHEN {t}{k}i THEN {t}{k}l || {t}{k}r ELSE '' END" for t, k in steps)
    count = " + ".join(f"CAST({t}{k}i AS BIGINT)" for t, k in steps)
    return f"""
WITH hashed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS part, {leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {leaf("text")} END AS altered FROM documents),
b AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY part) AS size FROM hashed),
t0 AS (SELECT part, place, leaf AS node, size FROM b),{",".join(_level("t", k) for k in range(levels))},
p AS (SELECT part AS source_part, node, row_number() OVER (ORDER BY part) - 1 AS place, count(*) OVER () AS size FROM t{levels}),
u0 AS (SELECT 0 AS part, place, node, size FROM p),{",".join(_level("u", k) for k in range(top_levels))},
joined AS (
  SELECT b.doc_id, leaf, altered, p.node AS subroot, (SELECT node FROM u{top_levels}) AS root, {columns}
  FROM b JOIN p ON p.source_part = b.part{joins}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, {before} AS folded_root, {before} = root AS verified, {count} AS n_steps
FROM f{len(steps) - 1}
"""


OP12_SQL = _op12()

OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS n,
         sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS c
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(c || ':' || CAST(n AS VARCHAR) ORDER BY turn NULLS FIRST, substr(c, 1, 1) < '8', substr(c, 1, 16), substr(c, 17, 1) < '8', substr(c, 17, 16)) AS l
  FROM t GROUP BY conv_id),
headed AS (SELECT *, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own),
built AS (SELECT o.conv_id, list_concat(coalesce(b.l[1:h], []), o.l[h + 1:]) AS l FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
r AS (
  SELECT conv_id, d, md5(array_to_string(l[1:d], ',')) AS k, md5(array_to_string(l[1:d - 1], ',')) AS up,
         CASE WHEN d > 0 THEN CAST(split_part(l[d], ':', 2) AS BIGINT) ELSE 0 END AS n, d = len(l) AS ends
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM built)),
node AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(n) AS n,
         string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ids FROM r GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY d, up),
known AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, k)),
below AS (
  SELECT r.d, r.k, sum((u.n_convs - 1) * u.n) AS saved, count_if(u.n_children = 0) AS leaves
  FROM known u JOIN r ON r.conv_id = u.conv_id AND r.d <= u.d GROUP BY r.d, r.k)
SELECT known.conv_id, CAST(known.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, known.n_convs, CAST(known.n_children AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(known.ids, '')) AS ends_sha256
FROM known JOIN below USING (d, k) LEFT JOIN known p ON known.d > 0 AND p.d = known.d - 1 AND p.k = known.up
"""



def _op8() -> str:
    lowered = lambda text: f"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    quoted = lambda text: text.replace("'", "''")
    templates = ", ".join(f"({k}, '{label}', '{quoted(text)}')" for k, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{quoted(text)}', '{label}')" for text, label in PHRASES)
    grams = f"array_to_string(w[i + 1 : i + {GRAM}], ' ')"
    rules = LicenseRules()
    return f"""
WITH doc AS (SELECT doc_id, {lowered("coalesce(text, '')")} AS w FROM documents),
template AS (SELECT t, label, {lowered("body")} AS w FROM (VALUES {templates}) v(t, label, body)),
phrase AS (SELECT label, string_split(body, ' ') AS p, body FROM (VALUES {phrases}) v(body, label)),
pos AS (SELECT t, label, i AS q, len(w) AS n, {grams} AS g FROM (SELECT *, unnest(range(0, len(w) - {GRAM} + 1)) AS i FROM template)),
gram AS (SELECT doc_id, i AS place, {grams} AS g FROM (SELECT *, unnest(range(0, len(w) - {GRAM} + 1)) AS i FROM doc)),
vote AS (SELECT DISTINCT doc_id, t, label, n, place - q AS d, q FROM gram JOIN pos USING (g)),
diagonal AS (SELECT doc_id, t, label, n, d, list(q) AS ats FROM vote GROUP BY doc_id, t, label, n, d),
edge AS (
  SELECT *, CASE WHEN d - lag(d) OVER o > {rules.slack} OR 2 * len(list_intersect(ats, lag(ats) OVER o)) > least(len(ats), len(lag(ats) OVER o))
                 THEN 1 ELSE 0 END AS apart FROM diagonal WINDOW o AS (PARTITION BY doc_id, t ORDER BY d)),
run AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, t ORDER BY d) AS r FROM edge),
word AS (SELECT DISTINCT doc_id, t, label, n, r, unnest(ats) AS q FROM run),
step AS (SELECT *, least({GRAM}, coalesce(lead(q) OVER (PARTITION BY doc_id, t, r ORDER BY q) - q, {GRAM})) AS c FROM word),
scored AS (SELECT doc_id, label, CAST(sum(c) AS DOUBLE) / CAST(n AS DOUBLE) AS score FROM step GROUP BY doc_id, t, label, n, r),
good AS (SELECT doc_id, max(score) AS score, list(DISTINCT label) AS labels FROM scored WHERE score >= {rules.similarity} GROUP BY doc_id),
named AS (
  SELECT doc_id, i, label FROM (SELECT doc_id, w, label, p, unnest(range(0, len(w) - len(p) + 1)) AS i FROM doc, phrase)
  WHERE w[i + 1 : i + len(p)] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS a, max(i) AS b, list(DISTINCT label) AS labels FROM named GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, a AS first_word, b AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(good.labels, [])))), ',') AS labels,
       coalesce(good.score, CAST(0 AS DOUBLE)) AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN good USING (doc_id)
"""


ORACLE: dict[str, str] = {"op2_suffix": OP2, "op4_secrets": OP4, "op7_mixing": OP7, "op8_licenses": _op8(), "op9_decontam": OP9, "op10_warc": OP10, "op11_pii": OP11, "op12_merkle": OP12_SQL, "op13_trie": OP13_SQL}
