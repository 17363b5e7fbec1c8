"""SQL twins of the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

# Windows of 20 words; one whose words also start earlier (smaller doc_id, or further left)
# takes its words away.
DOUBLED_WINDOWS = f"""
WITH listed AS (SELECT doc_id, {WORDS} AS w FROM documents),
placed AS (
  SELECT doc_id, place, md5(array_to_string(w[place + 1:place + 20], ' ')) AS window_words
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 19, 0))) AS place FROM listed)),
repeated AS (
  SELECT doc_id, place FROM (
    SELECT doc_id, place,
      row_number() OVER (PARTITION BY window_words ORDER BY doc_id, place) AS n
    FROM placed) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, place + unnest(range(20)) AS place FROM repeated),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM listed),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, (len(w) - coalesce(n, 0))::bigint AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM listed LEFT JOIN kept USING (doc_id)"""

# All pairs of vectors by cosine; components by walking the links.
PIVOT_CELLS = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::double[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
smallest AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::bigint AS n_links, component_id,
  component_id = vec_id AS kept
FROM embeddings e JOIN smallest USING (vec_id)"""


def _field(name: str, value: str | None = None) -> str:
    text = f"({value or name})::varchar"
    return f"CASE WHEN ({value or name}) IS NULL THEN '-' ELSE strlen({text})::varchar || ':' || {text} END"


def _leaf(n_chars: str = "n_chars") -> str:
    fields = [_field(x) for x in ("doc_id", "source", "lang")] + [_field("n_chars", n_chars), _field("text")]
    return f"sha256({' || '.join(fields)})"


def _levels(name: str, leaves: str, levels: int) -> str:
    """CTEs of a list's levels and, as `name`, of all nodes that have one above."""
    parts = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS (SELECT l.tree, l.pos // 2 AS pos, (l.n + 1) // 2 AS n,"
            f" CASE WHEN l.n = 1 THEN l.digest ELSE sha256(l.digest || coalesce(r.digest, '')) END AS digest"
            f" FROM {name}{k} l LEFT JOIN {name}{k} r ON r.tree = l.tree AND r.pos = l.pos + 1"
            f" WHERE l.pos % 2 = 0)"
        )
    union = " UNION ALL ".join(
        f"SELECT {k} AS level, tree, pos, digest FROM {name}{k} WHERE n > 1" for k in range(levels)
    )
    return ", ".join([*parts, f"{name} AS ({union})", f"{name}_heights AS (SELECT tree, max(level) + 1 AS height FROM {name} GROUP BY tree)"])


def _crc() -> str:
    """CTEs of the CRC-32 of each doc_id's digits: its table by rule, then digit by digit."""
    return """
entry(i, k, v) AS (
  SELECT i, 0, i FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM entry WHERE k < 8),
digits AS (SELECT DISTINCT doc_id, doc_id::varchar AS s FROM documents WHERE doc_id IS NOT NULL),
rolled(doc_id, s, place, crc) AS (
  SELECT doc_id, s, 0, 4294967295::bigint FROM digits
  UNION ALL
  SELECT r.doc_id, r.s, r.place + 1, xor(r.crc >> 8, e.v)
  FROM rolled r JOIN entry e ON e.k = 8 AND e.i = xor(r.crc, ascii(r.s[r.place + 1])) & 255
  WHERE r.place < len(r.s)),
crcs AS (SELECT doc_id, xor(crc, 4294967295::bigint) AS crc FROM rolled WHERE place = len(s))"""


def subtree_exchange(levels: int = 24, upper: int = 8) -> str:
    """The manifest, level by level; enough levels for 2^24 leaves and 2^8 languages."""
    folds = ["fold0 AS (SELECT doc_id, shown AS digest FROM proved)"]
    for k in range(levels + upper):
        folds.append(
            f"fold{k + 1} AS (SELECT f.doc_id, CASE WHEN s.doc_id IS NULL THEN f.digest"
            f" WHEN s.digest IS NULL THEN sha256(f.digest)"
            f" WHEN s.sits_left THEN sha256(s.digest || f.digest) ELSE sha256(f.digest || s.digest) END AS digest"
            f" FROM fold{k} f LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.step = {k})"
        )
    return f"""
WITH RECURSIVE {_crc()},
leaves AS (
  SELECT d.doc_id, coalesce('=' || lang, '') AS tree, {_leaf()} AS leaf,
    CASE WHEN crc % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf()} END AS shown
  FROM documents d LEFT JOIN crcs USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_levels('low', 'SELECT tree, pos, n, leaf AS digest FROM ranked', levels)},
subroots AS (
  SELECT tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM low{levels}),
{_levels('high', "SELECT '' AS tree, pos, n, digest FROM subroots", upper)},
proved AS (
  SELECT r.doc_id, r.leaf, r.shown, r.tree, r.pos, s.pos AS place, s.digest AS subroot,
    coalesce(h.height, 0) AS height, (SELECT digest FROM high{upper}) AS root
  FROM ranked r JOIN subroots s ON s.name = r.tree LEFT JOIN low_heights h ON h.tree = r.tree),
steps AS (
  SELECT p.doc_id, p.level AS step, o.digest, (p.pos >> p.level) % 2 = 1 AS sits_left
  FROM (SELECT *, unnest(range(height)) AS level FROM proved) p
  LEFT JOIN low o ON o.tree = p.tree AND o.level = p.level AND o.pos = xor(p.pos >> p.level, 1)
  UNION ALL
  SELECT p.doc_id, p.height + p.level, o.digest, (p.place >> p.level) % 2 = 1
  FROM (SELECT *, unnest(range(coalesce((SELECT height FROM high_heights), 0))) AS level FROM proved) p
  LEFT JOIN high o ON o.level = p.level AND o.pos = xor(p.place >> p.level, 1)),
proofs AS (SELECT doc_id, coalesce(string_agg(digest, '' ORDER BY step), '') AS siblings, count(*) AS height
  FROM steps GROUP BY doc_id),
{', '.join(folds)}
SELECT p.doc_id, p.leaf, p.subroot, p.root, sha256(coalesce(siblings, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = p.root AS verified, coalesce(o.height, 0)::int AS height
FROM proved p LEFT JOIN proofs o USING (doc_id) JOIN fold{levels + upper} f USING (doc_id)"""


# Runs as islands of equal words a lag apart; one that a run of a smaller period covers has
# that period.
SCALED_MINIMIZERS = f"""
WITH RECURSIVE {_crc()},
listed AS (SELECT doc_id, {WORDS} AS w, coalesce(crc, 1) AS h FROM documents LEFT JOIN crcs USING (doc_id)),
cut AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM listed),
planted AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i:
    w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + (h // 10) % 8)) END]) END AS w
  FROM cut),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place, len(w) AS n FROM planted),
same AS (
  SELECT x.doc_id, y.place - x.place AS lag, x.place FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.place > x.place AND 4 * (y.place - x.place) <= x.n),
islands AS (
  SELECT doc_id, lag, min(place) AS start, max(place) + 1 + lag AS stop
  FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id, lag ORDER BY place) AS island FROM same)
  GROUP BY doc_id, lag, island HAVING max(place) + 1 + lag - min(place) >= greatest(6, 4 * lag)),
runs AS (
  SELECT *, stop - start AS length FROM islands i WHERE NOT EXISTS (
    SELECT 1 FROM islands j WHERE j.doc_id = i.doc_id AND j.lag < i.lag AND j.start <= i.start AND j.stop >= i.stop)),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY length::double / lag DESC, start, lag) = 1),
lines AS (
  SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || lag || chr(10), '' ORDER BY start, lag) AS text
  FROM runs GROUP BY doc_id),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + lag, stop)) AS place FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT p.doc_id, coalesce(l.n, 0)::bigint AS n_runs, b.start::bigint AS start, b.length::bigint AS length,
  b.lag::bigint AS period, (1000 * b.length // b.lag)::bigint AS exponent_milli,
  sha256(coalesce(l.text, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256,
  len(p.w)::bigint AS n_words
FROM planted p LEFT JOIN lines l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)"""


ORACLE: dict[str, str] = {
    "op1_doubled_windows": DOUBLED_WINDOWS,
    "op5_pivot_cells": PIVOT_CELLS,
    "op11_scaled_minimizers": SCALED_MINIMIZERS,
    "op12_subtree_exchange": subtree_exchange(),
}
