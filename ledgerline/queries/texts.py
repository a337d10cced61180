"""Text, page, JSON and number expressions over documents, pages, conversations and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import dates, json, keys, numbers, text
from ledgerline.operators.rules import first_match
from ledgerline.plans import calls, gates
from ledgerline.plans import vocabulary as V
from ledgerline.plans.notices import segmented_lines
from ledgerline.queries.registry import Tables, query
from ledgerline.sources import pages, sinks

_ACC = "'áàâãäåçéèêëíìîïñóòôõöúùûüýÿºª', 'aaaaaaceeeeiiiinooooouuuuyyoa'"
_NORM = rf"""array_to_string(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(translate(lower(coalesce(text, '')), {_ACC}), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9_\s]', ' ', 'g'), '\s+'), lambda w: w <> '' AND w NOT IN ('de', 'da', 'do', 'das', 'dos', 'e', 'em')), ' ')"""
_FOLD = rf"""trim(regexp_replace(translate(lower(coalesce(text, '')), {_ACC}), '\s+', ' ', 'g'))"""


@query(f"SELECT doc_id, md5({_NORM}) AS normal FROM documents")
def normalise_text(t: Tables) -> DataFrame:
    """Normal form of texts (X1), as a digest."""
    return t.documents.select("doc_id", F.md5(text.normalise(F.col("text"))).alias("normal"))


@query(f"SELECT doc_id, md5({_FOLD}) AS folded FROM documents")
def fold_text(t: Tables) -> DataFrame:
    """Folded texts, punctuation kept."""
    return t.documents.select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"))


@query(rf"""SELECT doc_id, regexp_matches(' ' || {_NORM} || ' ', ' (that the|und der|que\w* la|la le) ') AS hit FROM documents""")
def phrase_match(t: Tables) -> DataFrame:
    """Adjacent whole tokens with open endings."""
    return t.documents.select("doc_id", text.has_phrase(text.normalise(F.col("text")), ["that the", "und der", "que* la", "la le"]).alias("hit"))


@query(f"SELECT doc_id, contains({_NORM}, 'licens') OR contains({_NORM}, 'tokens') AS hit FROM documents")
def substring_match(t: Tables) -> DataFrame:
    """Terms inside words too."""
    return t.documents.select("doc_id", text.has_substring(text.normalise(F.col("text")), ["licens", "tokens"]).alias("hit"))


@query(rf"""
WITH f AS (SELECT doc_id, {_FOLD} AS f FROM documents)
SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(f, '(^|[^a-z0-9_])mit($|[^a-z0-9_])') THEN 'mit' END, CASE WHEN regexp_matches(f, '(^|[^a-z0-9_])apres($|[^a-z0-9_])') THEN 'après' END, CASE WHEN regexp_matches(f, '(^|[^a-z0-9_])from($|[^a-z0-9_])') THEN 'from' END], lambda x: x IS NOT NULL), ',') AS words FROM f""")
def whole_words(t: Tables) -> DataFrame:
    """Terms that occur as whole words."""
    return t.documents.select("doc_id", F.array_join(text.matched_words(F.col("text"), ["mit", "après", "from"]), ",").alias("words"))


@query(r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)
SELECT doc_id, CAST(len(s) AS INTEGER) AS n FROM s""")
def sentence_counts(t: Tables) -> DataFrame:
    """Sentences of texts."""
    return t.documents.select("doc_id", F.size(text.sentences(F.col("text"))).alias("n"))


_GATES = {"G1": ("that the", "with"), "G2": ("der die", "nicht"), "G3": ("que", "pour")}


@query(rf"""
WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')) AS text FROM documents WHERE doc_id % 1 = 0),
p AS (SELECT doc_id, ' ' || regexp_replace({_FOLD}, '[^a-zA-Z0-9_]+', ' ', 'g') || ' ' AS f, {_FOLD} AS g FROM s),
v(gate, term) AS (VALUES ('G1', 'that the'), ('G1', 'with'), ('G2', 'der die'), ('G2', 'nicht'), ('G3', 'que'), ('G3', 'pour'))
SELECT doc_id, gate, count(*) AS hits FROM p JOIN v ON contains(f, ' ' || term || ' ') WHERE NOT (gate <> 'G3' AND contains(g, 'erre')) GROUP BY doc_id, gate""")
def gates_by_sentence(t: Tables) -> DataFrame:
    """Gates hit by sentences, negated ones dropped but for the exempt gate."""
    s = gates.gate_signals(t.documents, "doc_id", "text", _GATES, ("erre",), ("there is",), ("may be",), "G3")
    return s.groupBy("doc_id", "gate").agg(F.count("*").alias("hits"))


@query(r"""
WITH l AS (SELECT doc_id, regexp_replace(lower(text), '[^\x00-\x7F]', '', 'g') AS f FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(f, '\bthis work is\b') THEN 'obra' WHEN regexp_matches(f, '\breleased\b.{0,20}license') THEN 'liberado' WHEN regexp_matches(f, '\blicensed\b') THEN 'licenciado' ELSE 'indeterminado' END AS kind FROM l""")
def first_verb(t: Tables) -> DataFrame:
    """The first pattern of an ordered table; ``permit_verbs`` has the vocabulary of permits."""
    f = F.regexp_replace(F.lower("text"), r"[^\x00-\x7F]", "")
    rules = [(r"\bthis work is\b", "obra"), (r"\breleased\b.{0,20}license", "liberado"), (r"\blicensed\b", "licenciado")]
    return t.documents.select("doc_id", first_match([(f.rlike(p), k) for p, k in rules], "indeterminado").alias("kind"))


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '(?s)(.{0,25})licens', 1) AS w FROM documents)
SELECT doc_id, len(list_filter(w, lambda x: NOT contains(x, 'under ') AND NOT contains(x, 'is '))) > 0 AS hit FROM w""")
def unnegated_match(t: Tables) -> DataFrame:
    """A term without a negation in the characters before it."""
    return t.documents.select("doc_id", text.has_unnegated(F.col("text"), ["licens"], ("under ", "is ")).alias("hit"))


_NEGATED = "|".join(text.NEGATIONS)


@query(rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, lower(coalesce(text, '')) AS low FROM documents),
p AS (SELECT t.*, o, term, string_split(low, term) AS ps FROM t, (VALUES (1, 'license'), (2, 'token =')) v(o, term) WHERE contains(low, term)),
k AS (SELECT *, unnest(range(1, len(ps))) AS k FROM p),
i AS (SELECT doc_id, t, low, o, term, k, CAST(list_sum(list_transform(ps[1:k], lambda x: length(x))) + (k - 1) * length(term) + 1 AS BIGINT) AS i FROM k),
e AS (SELECT doc_id, o, k, trim(substring(t, greatest(i - 60, 1), i + length(term) + 60 - greatest(i - 60, 1))) AS x FROM i WHERE NOT regexp_matches(substring(low, greatest(i - 25, 1), least(i - 1, 25)), '{_NEGATED}')),
d AS (SELECT doc_id, x, min(o * 1000000 + k) AS pos FROM e GROUP BY doc_id, x), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n FROM d)
SELECT sha256(doc_id || '|licenca|' || n) AS id, doc_id, 'licenca' AS campo, substring(x, 1, 2000) AS trecho FROM n WHERE x <> ''""")
def excerpts_around(t: Tables) -> DataFrame:
    """Excerpts around the hits of terms."""
    e = t.documents.select("doc_id", text.excerpts(F.col("text"), ["license", "token ="], "licenca").alias("e"))
    return sinks.evidence_rows(e, "doc_id", F.col("e"))


_SENTENCES = r"""unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''))"""
_WORST = "CASE WHEN contains(f, '{0}') THEN CASE WHEN contains(f, 'may') OR contains(f, 'version') THEN 3 WHEN contains(f, 'not') THEN 2 ELSE 1 END END"


@query(rf"""
WITH s AS (SELECT doc_id, {_SENTENCES} AS text FROM documents), f AS (SELECT doc_id, {_FOLD} AS f FROM s),
g AS (SELECT doc_id, bool_or(contains(f, 'licensed under') OR contains(f, 'released under')) AS a, bool_or(contains(f, 'token =')) AS b, bool_or(contains(f, '@mail') OR contains(f, '+1 (')) AS c, max({_WORST.format("license")}) AS l, max({_WORST.format("@mail")}) AS r FROM f GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN g.doc_id IS NULL THEN 'VAZIO' WHEN a THEN 'LICENCA' WHEN b THEN 'SEGREDO' WHEN c THEN 'CONTATO' ELSE 'SEM_MARCA' END AS status,
  array_to_string(list_filter(['licenca=' || ['afirmado', 'negado', 'incerto'][l], 'rede=' || ['afirmado', 'negado', 'incerto'][r]], lambda x: x IS NOT NULL), ',') AS themes FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id""")
def text_states(t: Tables) -> DataFrame:
    """Status of texts by ordered markers, and the worst state of themes."""
    order = (("LICENCA", ("licensed under", "released under")), ("SEGREDO", ("token =",)), ("CONTATO", ("@mail", "+1 (")))
    worst = text.worst_state(F.col("text"), {"licenca": ("license",), "rede": ("@mail",)}, ("not ",), ("may ", "version"))
    return t.documents.select("doc_id", text.text_status(F.col("text"), order, "VAZIO", "SEM_MARCA").alias("status"), F.array_join(F.array_sort(F.transform(F.map_entries(worst), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",").alias("themes"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
b AS (SELECT doc_id, i, l, sum(CASE WHEN regexp_matches(l, '^[A-Z]{4}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM l WHERE trim(l) <> '')
SELECT doc_id, CAST(block AS BIGINT) AS block, count(*) AS lines, md5(string_agg(l, chr(10) ORDER BY i)) AS content FROM b GROUP BY doc_id, block""")
def segment_lines(t: Tables) -> DataFrame:
    """Documents cut into blocks at marked lines."""
    return segmented_lines(t.documents, "doc_id", "text", r"^[A-Z]{4}").select("doc_id", "block", "lines", F.md5("content").alias("content"))


_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["'']([^"''>]*)["''][^>]*>(.*?)</a>"""


@query(rf"""
WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS h, generate_subscripts(regexp_extract_all(html, '{_LINK}', 1), 1) - 1 AS position FROM pages),
c AS (SELECT *, trim(regexp_replace(replace(h, '&amp;', '&'), '#.*$', '')) AS x, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+/(?:[^?#/]*/)*)', 1) AS folder FROM a),
d AS (SELECT page_id, CAST(position AS INTEGER) AS position, CASE WHEN x = '' OR regexp_matches(lower(x), '^(mailto|javascript|tel|data):') THEN NULL WHEN regexp_matches(x, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN x WHEN x LIKE '//%' THEN regexp_extract(url, '^([a-zA-Z]+:)', 1) || x
  WHEN x LIKE '/%' THEN root || x ELSE CASE WHEN folder = '' THEN root || '/' ELSE folder END || x END AS link FROM c)
SELECT * FROM d WHERE link IS NOT NULL""")
def page_links(t: Tables) -> DataFrame:
    """Links of pages, absolute, in page order."""
    return pages.page_links(t.pages).select("page_id", "position", "link")


@query(rf"""
WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS h, generate_subscripts(regexp_extract_all(html, '{_LINK}', 1), 1) - 1 AS position FROM pages),
c AS (SELECT *, trim(regexp_replace(replace(h, '&amp;', '&'), '#.*$', '')) AS x, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+/(?:[^?#/]*/)*)', 1) AS folder FROM a),
d AS (SELECT page_id, CAST(position AS INTEGER) AS position, CASE WHEN x = '' OR regexp_matches(lower(x), '^(mailto|javascript|tel|data):') THEN NULL WHEN regexp_matches(x, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN x WHEN x LIKE '//%' THEN regexp_extract(url, '^([a-zA-Z]+:)', 1) || x
  WHEN x LIKE '/%' THEN root || x ELSE CASE WHEN folder = '' THEN root || '/' ELSE folder END || x END AS link FROM c),
e AS (SELECT page_id, link, min(position) AS position FROM d WHERE link IS NOT NULL GROUP BY page_id, link),
x AS (SELECT *, lower(regexp_extract(link, '\.([A-Za-z0-9]{{2,5}})(?:\?.*)?$', 1)) AS extension FROM e),
n AS (SELECT *, extension IN ('pdf', 'doc', 'docx') AS is_document, sum((extension IN ('pdf', 'doc', 'docx'))::INT) OVER (PARTITION BY page_id ORDER BY position) AS nth FROM x),
m AS (SELECT page_id, count(DISTINCT link) AS c FROM d WHERE link IS NOT NULL AND regexp_matches(link, '[?&](?:page|pagina|start)=([0-9]+)') GROUP BY page_id)
SELECT n.page_id, position, link, extension, is_document, contains(link, 'example.com') AS allowed, coalesce(c, 0) AS next_pages FROM n LEFT JOIN m ON n.page_id = m.page_id WHERE NOT is_document OR nth <= 40""")
def link_inventory(t: Tables) -> DataFrame:
    """First occurrences of links, with flags, documents limited per page."""
    links = pages.page_links(t.pages)
    inv = pages.link_inventory(links, F.contains("link", F.lit("example.com")), ["pdf", "doc", "docx"])
    more = pages.next_pages(links).groupBy("page_id").agg(F.count("*").alias("next_pages"))
    return inv.join(more, "page_id", "left").select("page_id", "position", "link", "extension", "is_document", "allowed", F.coalesce("next_pages", F.lit(0)).alias("next_pages"))


@query(rf"""
WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS h, unnest(regexp_extract_all(html, '{_LINK}', 2)) AS t, generate_subscripts(regexp_extract_all(html, '{_LINK}', 1), 1) - 1 AS position FROM pages),
c AS (SELECT *, trim(regexp_replace(replace(h, '&amp;', '&'), '#.*$', '')) AS x, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+/(?:[^?#/]*/)*)', 1) AS folder, trim(regexp_replace(regexp_replace(t, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM a),
d AS (SELECT *, CASE WHEN x = '' OR regexp_matches(lower(x), '^(mailto|javascript|tel|data):') THEN NULL WHEN regexp_matches(x, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN x WHEN x LIKE '//%' THEN regexp_extract(url, '^([a-zA-Z]+:)', 1) || x WHEN x LIKE '/%' THEN root || x ELSE CASE WHEN folder = '' THEN root || '/' ELSE folder END || x END AS link FROM c),
i AS (SELECT *, regexp_extract(link, '/([A-Za-zÀ-ÿ]{{3,}})[^/]*$', 1) AS item FROM d WHERE link IS NOT NULL),
o AS (SELECT * FROM i WHERE item <> '' QUALIFY row_number() OVER (PARTITION BY item ORDER BY page_id, position) = 1)
SELECT item, link, title, coalesce(TRY_CAST(try_strptime(nullif(translate(regexp_extract(title, '([0-9]{{2}})[/.-]([0-9]{{2}})[/.-]([0-9]{{4}})', 0), '.-', '//'), ''), '%d/%m/%Y') AS DATE), TRY_CAST(nullif(regexp_extract(title, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '') AS DATE)) AS day,
  sha256(trim(item || '|' || title || '|' || link)) AS hash, nullif(regexp_extract(title, '^\s*(.+?)\s*[/-]\s*([A-Z]{{2}})\b', 1), '') AS place, nullif(regexp_extract(title, '^\s*(.+?)\s*[/-]\s*([A-Z]{{2}})\b', 2), '') AS state FROM o""")
def page_list_items(t: Tables) -> DataFrame:
    """Items of list pages by id, the first of each, with title parts and announced totals."""
    items = pages.list_items(pages.page_links(t.pages), r"/([A-Za-zÀ-ÿ]{3,})[^/]*$")
    return items.select("item", "link", "title", "day", "hash", pages.title_parts(F.col("title")).alias("p")).select("item", "link", "title", "day", "hash", "p.place", "p.state")


_BLOCKS = "html"
for _tag in ("script", "style", "nav", "header", "footer"):
    _BLOCKS = rf"regexp_replace({_BLOCKS}, '(?is)<{_tag}\b.*?</{_tag}\s*>', ' ', 'g')"
_PLAIN = rf"regexp_replace(regexp_replace({_BLOCKS}, '(?i)<br\s*/?>|</(p|div|li|tr|h[1-6]|td|title)\s*>', chr(10), 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _PLAIN = f"replace({_PLAIN}, '{_entity}', '{_char}')"


@query(rf"""
WITH p AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split({_PLAIN}, chr(10)), lambda x: trim(regexp_replace(x, '[ \t\r\f]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS t,
  regexp_extract(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '(?i)(?:total(?:\s+de)?|resultados?\s*:?)\s*:?\s*(\d{{1,7}})', 1) AS a FROM pages)
SELECT page_id, md5(t) AS text_md5, length(t) AS chars, CAST(nullif(a, '') AS INTEGER) AS announced FROM p""")
def page_text(t: Tables) -> DataFrame:
    """Plain text of pages and its size."""
    plain = text.plain_text(F.col("html"))
    return t.pages.select("page_id", F.md5(plain).alias("text_md5"), F.length(plain).alias("chars"), pages.announced_total(F.col("html")).alias("announced"))


@query("""
SELECT event_id, json_type(props, '$.k') = 'UBIGINT' OR json_type(props, '$.k') = 'BIGINT' AS is_number, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, CASE WHEN event_type = 'error' THEN value > 50 ELSE false END AS is_true FROM events""")
def json_typed(t: Tables) -> DataFrame:
    """Typed JSON checks: the text "true" is not the boolean."""
    v, e = json.parsed(F.col("props")), F.col("event_type") == "error"
    flag = F.when(e & (F.col("value") > 50), "true").when(e, "false").otherwise('"true"')
    w = json.parsed(F.concat(F.lit('{"p": '), flag, F.lit("}")))
    return t.events.select("event_id", (json.path_type(v, "$.k") == "BIGINT").alias("is_number"), json.path_text(v, "$.k").alias("k"), json.is_json_bool(w, "$.p", True).alias("is_true"))


@query(r"""
WITH q AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS src, role FROM conversations),
n AS (SELECT conv_id, turn, list_distinct(list_transform(regexp_extract_all(text, '\d+(?:[.,]\d+)*'), lambda x: replace(regexp_replace(x, '\.(\d{3})($|\D)', '\1\2', 'g'), ',', '.'))) AS a,
  list_distinct(list_transform(regexp_extract_all(coalesce(src, ''), '\d+(?:[.,]\d+)*'), lambda x: replace(regexp_replace(x, '\.(\d{3})($|\D)', '\1\2', 'g'), ',', '.'))) AS b FROM q WHERE role = 'assistant')
SELECT conv_id, turn, CAST(len(list_filter(a, lambda x: NOT list_contains(b, x))) AS INTEGER) AS ungrounded FROM n""")
def number_grounding(t: Tables) -> DataFrame:
    """Numbers of an answer that its question lacks."""
    q = t.conversations.withColumn("src", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("role = 'assistant'")
    return q.select("conv_id", "turn", F.size(calls.ungrounded_numbers(F.col("text"), F.col("src"))).alias("ungrounded"))


_NUMBERS = r"list_distinct(list_transform(regexp_extract_all({}, '\d+(?:[.,]\d+)*'), lambda x: replace(regexp_replace(x, '\.(\d{{3}})($|\D)', '\1\2', 'g'), ',', '.')))"


@query(rf"""
WITH q AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS src, role FROM conversations),
w AS (SELECT *, turn % 2 = 1 AS fatos, text || CASE WHEN turn % 2 = 1 THEN chr(10) || role ELSE '' END AS inteiro FROM q WHERE role = 'assistant'),
n AS (SELECT *, {_NUMBERS.format(r"regexp_replace(inteiro, '\[\d+\]', ' ', 'g')")} AS a, {_NUMBERS.format("coalesce(src, '')")} AS b, {_FOLD.replace("text", "inteiro")} AS f FROM w)
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN NOT fatos THEN 'falta:fatos' END, CASE WHEN length(text) NOT BETWEEN 20 AND 4000 THEN 'tamanho:resumo' END, CASE WHEN fatos THEN 'tamanho:fatos' END,
  CASE WHEN len(list_filter(regexp_extract_all(inteiro, '\[(\d+)\]', 1), lambda x: coalesce(TRY_CAST(x AS INTEGER) NOT BETWEEN 1 AND 3, false))) > 0 THEN 'citacao_fora_do_dossie' END, CASE WHEN len(list_filter(a, lambda x: NOT list_contains(b, x))) > 0 THEN 'numero_sem_fonte' END,
  {", ".join(f"CASE WHEN contains(f, '{w}') THEN 'termo_vedado:{w}' END" for w in calls.BARRED_WORDS)}], lambda x: x IS NOT NULL), ',') AS errors FROM n""")
def response_audit(t: Tables) -> DataFrame:
    """Errors of stored responses: each assistant turn, whole, against the turn before it."""
    q = t.conversations.withColumn("src", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("role = 'assistant'")
    body = F.to_json(F.struct(F.col("text").alias("resumo"), F.when(F.col("turn") % 2 == 1, F.col("role")).alias("fatos")))
    return q.select("conv_id", "turn", F.array_join(calls.response_errors(body, F.col("src"), 3, ["resumo", "fatos"]), ",").alias("errors"))


@query("""SELECT doc_id, sha256(trim(coalesce(text, ''), ' ')) AS line_hash, sha256(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS input_hash FROM documents""")
def text_hashes(t: Tables) -> DataFrame:
    """Hashes of lines and inputs (K5, K6)."""
    return t.documents.select("doc_id", keys.line_hash(F.col("text")).alias("line_hash"), keys.input_hash(F.col("text")).alias("input_hash"))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-11-05') AS age, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 YEAR AS DATE) AS deadline,
  greatest((year(DATE '2000-03-15') - year(CAST(o_orderdate AS DATE) + INTERVAL 2 YEAR)) * -12 - (month(DATE '2000-03-15') - month(CAST(o_orderdate AS DATE) + INTERVAL 2 YEAR)) + CASE WHEN day(CAST(o_orderdate AS DATE) + INTERVAL 2 YEAR) > 15 THEN 1 ELSE 0 END, 0) AS months FROM orders""")
def date_functions(t: Tables) -> DataFrame:
    """Day parsing, ages, deadlines, whole months."""
    written = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    day = dates.to_day(written)
    d = t.orders.select("o_orderkey", day.alias("day"))
    two = dates.add_years(F.col("day"), 2)
    return d.select("o_orderkey", "day", dates.age_days(F.col("day"), F.lit("2001-11-05").cast("date")).cast("long").alias("age"), two.alias("deadline"), dates.months_until(F.lit("2000-03-15").cast("date"), two).cast("long").alias("months"))


@query("""
SELECT event_id, ts AS moment, CAST(floor(date_diff('second', date_trunc('second', TIMESTAMP '2024-01-01 06:30:00'), date_trunc('second', ts)) / 60.0) AS BIGINT) AS delay FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def local_moments(t: Tables) -> DataFrame:
    """Times written in a fixed zone, and delays in minutes."""
    written = F.date_format(F.col("ts") - F.expr("INTERVAL 3 HOURS"), "dd/MM/yyyy HH:mm:ss")
    d = t.events.select("event_id", dates.local_moment(written).alias("moment"))
    return d.withColumn("delay", dates.delay_minutes(F.lit("2024-01-01 06:30:00").cast("timestamp"), F.col("moment")))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice AS pt, CASE WHEN l_linenumber % 2 = 0 THEN 0.0::DOUBLE ELSE floor(l_extendedprice) END AS dump, least(l_quantity / 40.0::DOUBLE * 100, 100.0::DOUBLE) AS normal FROM lineitem""")
def number_functions(t: Tables) -> DataFrame:
    """Comma decimals, dump areas, normalised scores."""
    cents = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    pt = F.concat(F.regexp_replace(F.split_part(cents, F.lit("."), F.lit(1)), r"(\d)(?=(\d{3})+$)", "$1."), F.lit(","), F.split_part(cents, F.lit("."), F.lit(2)))
    dump = F.when(F.col("l_linenumber") % 2 == 0, "1.852,42").otherwise(F.floor("l_extendedprice").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.number_pt(pt).alias("pt"), numbers.dump_area(dump).alias("dump"), numbers.normalised_score(F.col("l_quantity"), 40).alias("normal"))


@query("""
SELECT p_partkey, p_name AS first, 'ref-' || array_to_string(string_split(lower(p_name), ' '), '-') AS slug, CAST(p_size * 3 AS DOUBLE) AS area, CASE WHEN p_size % 2 = 0 THEN p_size || '/2020' END AS instrument FROM part""")
def record_fields(t: Tables) -> DataFrame:
    """First filled texts, slugs, largest areas, instrument numbers."""
    z = F.col("p_size").cast("string")
    said = F.concat(F.lit("área de "), z, F.lit(" ha e "), (F.col("p_size") * 3).cast("string"), F.lit(" hectares"))
    named = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Guia Nº "), z, F.lit("/2020"))).otherwise(F.concat(F.lit("GU - "), z, F.lit("/2020")))
    return t.part.select("p_partkey", text.first_filled(F.lit("  "), F.col("p_name")).alias("first"), keys.slug_id("ref-", F.col("p_name")).alias("slug"), numbers.largest_area(said).alias("area"), keys.instrument_of(named).alias("instrument"))


@query("""SELECT event_id, 'falha: token=*** em ' || event_type AS erro FROM events""")
def redacted_errors(t: Tables) -> DataFrame:
    """Error texts on one line with secrets masked."""
    e = F.concat(F.lit("falha:\n token=abc"), F.col("event_id").cast("string"), F.lit(" em "), F.col("event_type"))
    return t.events.select("event_id", text.redacted(e).alias("erro"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'negativo' WHEN c_mktsegment = 'MACHINERY' THEN 'em_tramite' WHEN c_mktsegment = 'FURNITURE' THEN 'concluido' ELSE 'indefinido' END AS status FROM customer""")
def suffix_status(t: Tables) -> DataFrame:
    """Status from whole tokens, negative before pending before done."""
    n = text.normalise(F.concat(F.lit("x "), F.col("c_mktsegment"), F.lit(" furniture_")))
    return t.customer.select("c_custkey", text.suffix_status(n, ["building"], ["machinery"], ["furniture"]).alias("status"))


_SAYS = lambda marks: "(" + " OR ".join(f"contains(g, '{text.folded(m)}')" for m in marks) + ")"
_STATUS = "CASE WHEN count(*) = 0 THEN 'AUSENCIA_DE_INFORMACAO' " + " ".join(f"WHEN bool_or({_SAYS(ms)}) THEN '{label}'" for label, ms in V.TEXT_STATUS) + " ELSE 'SINAL_SEM_STATUS_CONCLUSIVO' END"


@query(rf"""
WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')) AS text FROM documents),
p AS (SELECT doc_id, ' ' || regexp_replace({_FOLD}, '[^a-zA-Z0-9_]+', ' ', 'g') || ' ' AS f, {_FOLD} AS g FROM s), v(gate, term) AS (VALUES {", ".join(f"('{g}', '{w}')" for g, ws in _GATES.items() for w in ws)}),
h AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(gate))), ',') AS portas, bool_or({_SAYS(V.ALLEGED_MARKS)} OR {_SAYS(V.RISK_MARKS)}) AS incerta FROM p JOIN v ON contains(f, ' ' || term || ' ') WHERE NOT {_SAYS(V.NEGATIVE_MARKS)} GROUP BY doc_id),
q AS (SELECT doc_id, {_STATUS} AS semantica FROM p GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(portas, '') AS portas, coalesce(incerta, false) AS incerta, coalesce(semantica, 'AUSENCIA_DE_INFORMACAO') AS semantica, trim(coalesce(text, '')) = '' AS vazio,
  CASE WHEN regexp_matches({_FOLD}, '(^|[^a-z0-9_])(and|und|license)($|[^a-z0-9_])') THEN 'DIRETO' ELSE 'NAO_COMPROVADO' END AS vinculo FROM documents LEFT JOIN h USING (doc_id) LEFT JOIN q USING (doc_id)),
r AS (SELECT *, CASE WHEN vazio THEN 'NAO_AVALIAVEL' WHEN vinculo = 'NAO_COMPROVADO' THEN 'FORA_DO_ESCOPO' WHEN portas <> '' THEN 'CLASSIFICAR_AGORA' ELSE 'PENDENTE_DE_EVIDENCIA' END AS resultado FROM d)
SELECT doc_id, vinculo, portas, resultado, CASE WHEN vazio THEN 'documento_ou_conteudo_ausente' WHEN vinculo = 'NAO_COMPROVADO' THEN 'vinculo_minerario_nao_comprovado' WHEN portas <> '' THEN 'porta_editorial_ativada' ELSE 'nenhuma_porta_identificada' END AS motivo, semantica,
  resultado IN ('NAO_AVALIAVEL', 'PENDENTE_DE_EVIDENCIA') OR incerta AS requer_revisao, resultado = 'CLASSIFICAR_AGORA' AS selecionavel FROM r""")
def discovery(t: Tables) -> DataFrame:
    """Discovery of documents: sector link, gates, result, review."""
    d = t.documents.select("doc_id", "text")
    found = gates.discovered(d, "doc_id", "text", gates=_GATES, sector=("and", "und", "license"))
    return found.withColumn("portas", F.array_join("portas", ","))


@query("""
SELECT o_orderkey, CASE WHEN DATE '2001-11-05' > CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 YEAR AS DATE) THEN 'PRAZO_VENCIDO' WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-11-05') > 365 THEN 'INATIVO'
  WHEN (year(CAST(o_orderdate AS DATE) + INTERVAL 3 YEAR) - 2001) * 12 + month(CAST(o_orderdate AS DATE) + INTERVAL 3 YEAR) - 11 + CASE WHEN day(CAST(o_orderdate AS DATE) + INTERVAL 3 YEAR) > 5 THEN 1 ELSE 0 END <= 6 THEN 'PRAZO_PROXIMO' ELSE 'EM_CURSO' END AS status FROM orders""")
def inactivity_audit(t: Tables) -> DataFrame:
    """Deadlines and inactivity."""
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", gates.inactivity(day, day, F.lit("2001-11-05").cast("date"), 3, 1)["status"].alias("status"))


@query("""
SELECT c_custkey, campo, trecho FROM (SELECT c_custkey, 'c_name' AS campo, c_name AS trecho FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'nation', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0)""")
def field_evidence(t: Tables) -> DataFrame:
    """Filled fields as evidence rows."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("nation", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")))
    return sinks.evidence_rows(c.withColumn("e", sinks.filled_fields(["c_name", "c_mktsegment", "nation"])), "c_custkey", F.col("e")).select("c_custkey", "campo", "trecho")
