"""The registered queries of this subpackage and their DuckDB oracles.

Every query applies its operator with production parameters to the whole of its
table and derives the columns of its result from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bestfit, chat, convtrie, decontam, exact_dedup, html_extract, langid, merkle, packing, quality, secrets, simhash, toxicity
from .common import fold, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by machines learnt outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    found = langid.predict_language(docs.select("doc_id", "text"), langid.train(docs, folds=4, held_out=2))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


#: Text of conversation -7: control strings of common templates.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query("op2_chat_format", r"""
with m as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, replace(replace(replace(role, '\', '\\'), '|', '\|'), chr(10), '\n') as erole,
         replace(replace(text, '\', '\\'), '|', '\|') as etext
  from m)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, etext)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, etext) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('<|turn|>' || erole || chr(10) || etext || '<|end|>' || chr(10)))::bigint as formatted_chars
from e group by conv_id
""")
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted text; the masked text is cut at the loss spans."""
    talk = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(CONTROL_TEXT).alias("text"))
        for turn, role in enumerate(("user", "assistant"))])))
    messages = talk.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"))
    out = chat.format_chat(messages).withColumn("turns", chat.read_back(F.col("formatted"))) \
        .withColumn("masked", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("masked").cast("long").alias("loss_chars"),
                      F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    net = toxicity.train(docs, labels, folds=5, held_out=0)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), net, "score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: shingles of 3 words, at most 2 differing bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=1)


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents within their error budget."""
    return decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _duck_spans(pattern: str, keep: str = "true") -> str:
    """DuckDB list of (s, e, m) of a pattern's matches: lengths of the text between matches and of the matches, summed up."""
    return f"""
      (select list({{'s': s, 'e': s + length(m), 'm': m}} order by s) from (
        select m, coalesce(sum(length(g) + length(m)) over (order by i rows between unbounded preceding and 1 preceding), 0) + length(g) as s
        from (select unnest(ms) as m, unnest(gs[1:len(ms)]) as g, unnest(range(len(ms))) as i
              from (select regexp_extract_all(t, {pattern}) as ms, string_split_regex(t, {pattern}) as gs))) where {keep})"""


_ASSIGN = """'(?i)(?:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9+/_.=-]+'"""
_ASSIGN_KEEP = """length(regexp_extract(m, '(?i)(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)) >= 6"""
_ALLOWED = " or ".join(f"regexp_matches(m, '{p}')" for p in secrets.ALLOW)


def _duck_entropy(cs: str, least: float) -> str:
    """DuckDB list of the (s, e) that windows of enough entropy cover, of a list ``cs`` of candidates (s, e, m)."""
    window = f"list_filter(range(0, length(c.m) - {secrets.WINDOW - 1}), lambda i: list_aggregate(string_split(substr(c.m, (i + 1)::int, {secrets.WINDOW}), ''), 'entropy') >= {least})"
    hot = f"list_transform({cs}, lambda c: {{'s': c.s, 'm': c.m, 'lo': list_min({window}), 'hi': list_max({window}) + {secrets.WINDOW}}})"
    pieces = f"string_split_regex(substr(y.m, (y.lo + 1)::int, (y.hi - y.lo)::int), '{secrets.PLACEHOLDER}')"
    real = f"list_filter({hot}, lambda y: y.lo is not null and len(list_filter({pieces}, lambda p: length(p) >= {secrets.WINDOW})) > 0)"
    return f"list_transform({real}, lambda y: {{'s': y.s + y.lo, 'e': y.s + y.hi}})"


_MIXED = f"regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Za-z]') and not ({_ALLOWED})"


def _duck_one_case(letters: str) -> str:
    """Maximal runs of letters and digits that are of one case and not all hex digits."""
    return _duck_spans("'[A-Za-z0-9]{20,}'", f"regexp_full_match(m, '[{letters}0-9]+') and not regexp_full_match(m, '[0-9A-Fa-f]+') and {_MIXED}")


OP6_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
f as (select doc_id, {_duck_spans(_ASSIGN, _ASSIGN_KEEP)} as a, {_duck_spans("'AKIA[A-Z0-9]{16,}'")} as k, {_duck_spans("'[0-9a-f]{24,}'")} as h,
        {_duck_spans("'[0-9A-Fa-f]{20,}'", _MIXED)} as c0, {_duck_spans("'[A-Za-z0-9+/_=-]{20,}'", _MIXED)} as c1,
        {_duck_one_case('a-z')} as c2, {_duck_one_case('A-Z')} as c3
      from d),
e as (select doc_id, a, k, h, {', '.join(f"{_duck_entropy(f'c{i}', c[3])} as e{i}" for i, c in enumerate(secrets.CLASSES))} from f),
u as (
  select doc_id, 0 as kind, 'assign' as name, unnest(a) as x from e union all
  select doc_id, 1, 'access', unnest(k) from e union all
  select doc_id, 2, 'hex', unnest(h) from e),
b as (select doc_id, kind, name, x.s as s, x.e as e from u),
v as ({' union all '.join(f"select doc_id, {3 + i} as kind, '{c[0]}' as name, unnest(e{i}) as x from e" for i, c in enumerate(secrets.CLASSES))}),
w as (select doc_id, kind, name, x.s as s, x.e as e from v),
n as (select * from w where not exists (select 1 from b where b.doc_id = w.doc_id and b.s <= w.s and b.e >= w.e)),
al as (select * from b union all select * from n)
select d.doc_id, coalesce(sum((kind = 0)::int), 0)::bigint as n_assign, coalesce(sum((kind = 1)::int), 0)::bigint as n_access,
       coalesce(sum((kind = 2)::int), 0)::bigint as n_hex,
       sha256(coalesce(string_agg(name || ':' || s || ':' || e, ',' order by s, kind) filter (kind < 3), '')) as base_sha256,
       coalesce(string_agg(name || ':' || s || ':' || e, ',' order by s, kind), '') as spans
from d left join al using (doc_id) group by d.doc_id
"""


@query("op6_secret_scan", OP6_SQL)
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    out = secrets.scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind_no"] == secrets.KINDS.index(kind))).cast("long")

    return out.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                      F.sha2(secrets.as_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
                      secrets.as_text(F.sort_array(F.concat("base_spans", "entropy_spans"))).alias("spans"))


@query("op7_exact_dedup", """
with n as (
  select doc_id, length(coalesce(text, '')) as n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as text_sha256
  from documents),
r as (
  select *, count(*) over (partition by text_sha256) as group_size,
         first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id) as keep_id
  from n)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from r
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and survivor of every document; the digest column needs a hash of rows that are alone, too."""
    out = exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), hash_all=True)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"))


@query("op9_html_extraction")
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages")
    out = html_extract.extract_main_text(pages.select("page_id", "url", "html"), html_extract.train(pages), "text")
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality.train(docs, labels, folds=3, held_out=1)
    scored = quality.score_quality(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in as few sequences of 1024 tokens as best fit needs."""
    return bestfit.best_fit_pack(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


def _duck_crc32(text: str) -> str:
    """DuckDB CRC-32 of an ASCII text: each byte is xored in, then eight shifts follow (-1 marks a shift)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce({steps}, lambda a, e: case when e >= 0 then xor(a, e) else xor(a >> 1, 3988292384 * (a & 1)) end, 4294967295::bigint), "
            "4294967295::bigint)")


OP12_SQL = f"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
c as (select conv_id, {_duck_crc32('conv_id::varchar')} % 9 as h, conv_id - conv_id % 5 as base, count(*) as own from t group by conv_id),
h as (select c.conv_id, c.h, c.base, coalesce(least(c.h, b.own), 0) as head from c left join c b on b.conv_id = c.base),
r as (
  select h.conv_id, t.pos, t.role, t.text from h join t on t.conv_id = h.base and t.pos <= h.h
  union all select h.conv_id, h.head + t.pos - h.h, t.role, t.text from h join t on t.conv_id = h.conv_id and t.pos > h.h),
k as (
  select conv_id, pos as depth, strlen(text) as bytes,
         string_agg(sha256(strlen(role) || ':' || role || text), '') over (partition by conv_id order by pos rows between unbounded preceding and current row) as path
  from r),
m as (
  select conv_id, depth, bytes, sha256(path) as key, coalesce(lag(sha256(path)) over (partition by conv_id order by depth), '') as parent_key from k
  union all select conv_id, 0, 0, '', null from c),
n as (select key, any_value(depth) as depth, any_value(parent_key) as parent_key, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n_convs from m group by key),
ch as (select parent_key as key, count(*) as n_children from n where parent_key is not null group by parent_key),
f as (select n.*, coalesce(ch.n_children, 0) as n_children from n left join ch using (key)),
s as (
  select m.key, sum((f.n_children = 0)::int) as n_leaves, sum((f.n_convs - 1) * f.bytes) as saved_tokens
  from f join m on m.conv_id = f.conv_id and m.depth <= f.depth group by m.key),
d as (select conv_id, max(depth) as depth from m group by conv_id),
e as (select m.key, string_agg(d.conv_id::varchar, ',' order by d.conv_id) as ids from d join m using (conv_id, depth) group by m.key)
select f.conv_id, f.depth::bigint as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children,
       s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from f join s using (key) left join f p on p.key = f.parent_key left join e on e.key = f.key
"""


@query("op12_conversation_trie", OP12_SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return convtrie.prefix_trie(read(spark, sf_dir, "conversations"))


def _op13_sql(levels: int) -> str:
    """Both trees, unrolled: at each level a group with several nodes goes on to the hashes of its runs, one with a single node stays."""
    fan = merkle.FANOUT

    def tree(prefix: str, base: str, group: str) -> str:
        parts = [f"{prefix}0 as ({base})"]
        for k in range(levels):
            run = f"(partition by {group}, pos // {fan} order by pos rows between"
            parts.append(f"""{prefix}s{k} as (select {group}, pos, n,
                coalesce(string_agg(d, '') over {run} unbounded preceding and 1 preceding), '') as l,
                coalesce(string_agg(d, '') over {run} 1 following and unbounded following), '') as r from {prefix}{k})""")
            parts.append(f"""{prefix}{k + 1} as (
                select {group}, pos // {fan} as pos, (any_value(n) + {fan - 1}) // {fan} as n, sha256(string_agg(d, '' order by pos)) as d
                from {prefix}{k} where n > 1 group by {group}, pos // {fan}
                union all select {group}, pos, n, d from {prefix}{k} where n = 1)""")
        return ",\n".join(parts)

    def enc(value: str) -> str:
        return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    steps, proof, folded = [], [], "coalesce(tampered, leaf)"
    for prefix, group, at in (("a", "src", "a_pos"), ("b", "g", "b_pos")):
        for k in range(levels):
            alias = f"{prefix}x{k}"
            steps.append(f"join {prefix}s{k} {alias} on {alias}.{group} = v.{group} and {alias}.pos = case when {alias}.n = 1 then 0 else v.{at} // {fan ** k} end")
            proof.append(f"case when {alias}.n > 1 then {alias}.l || {alias}.r else '' end")
    sides = [(f"{prefix}x{k}") for prefix in "ab" for k in range(levels)]
    chain, before = [], "f0"
    for i, alias in enumerate(sides):
        chain.append(f"f{i + 1} as (select * exclude (f), case when n{i} > 1 then sha256(l{i} || f || r{i}) else f end as f from {before})")
        before = f"f{i + 1}"
    picked = ", ".join(f"{alias}.n as n{i}, {alias}.l as l{i}, {alias}.r as r{i}" for i, alias in enumerate(sides))
    return f"""
with v0 as (
  select doc_id, coalesce('=' || source, '') as src, {leaf('text')} as leaf,
         case when {_duck_crc32('doc_id::varchar')} % 5 = 0 then {leaf(lower)} end as tampered from documents),
v1 as (select *, row_number() over (partition by src order by doc_id nulls first, leaf) - 1 as a_pos, count(*) over (partition by src) as n from v0),
{tree('a', 'select src, a_pos as pos, n, leaf as d from v1', 'src')},
s as (select src, d, row_number() over (order by src) - 1 as pos, count(*) over () as n from a{levels}),
{tree('b', "select 0 as g, pos, n, d from s", 'g')},
v as (select v1.*, s.pos as b_pos, s.d as subroot, 0 as g from v1 join s using (src)),
f0 as (select v.doc_id, v.leaf, v.subroot, {' || '.join(proof)} as proof, {picked}, {folded} as f from v {' '.join(steps)}),
{', '.join(chain)}
select doc_id, leaf, subroot, r.d as root, sha256(proof) as proof_sha256, f as folded_root, f = r.d as verified
from {before}, b{levels} r
"""


@query("op13_merkle_manifest", _op13_sql(6))
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document; some rows are tampered with."""
    out = merkle.merkle_manifest(read(spark, sf_dir, "documents"))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = merkle.fold(F.col("path"), F.coalesce("tampered", "leaf"))
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.digest(proof).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
