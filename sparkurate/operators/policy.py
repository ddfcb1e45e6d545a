"""Decision policies as ordered conditions over joined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import is_spelling_merge
from ..functions.web import host, matches_domain
from .matching import first_by

AUTO_APPLY, LLM_LEAST = 0.90, 0.80
JUNK_LEAST, MATCH_LEAST, NEW_LEAST, EXACT, FUZZY_LEAST, OVERLAP_LEAST = 0.90, 0.85, 0.90, 0.98, 0.85, 0.90
TOP_POSITIONS = 3


def decide(candidates: DataFrame, collisions: DataFrame, aliases: DataFrame, evidence: DataFrame, scores: DataFrame) -> DataFrame:
    """(id, decision, target_id, canonical, confidence, reason), one row per candidate(id, name).

    collisions(id, target_id, created_at, canonical), aliases(id, target_id), evidence(id, seq, source,
    found, lookup_type, canonical, confidence), scores as from spelling_candidates(). In order: the oldest
    equal canonical name; one target with that alias; several; a safe spelling correction; a verifying
    source; a person.
    """
    same = first_by(collisions.select("id", "created_at", "target_id", "canonical"), ["id"], [F.col("created_at"), F.col("target_id")]).select("id", F.col("target_id").alias("c_target"), F.col("canonical").alias("c_name"))
    alias = aliases.where("target_id is not null").groupBy("id").agg(F.count_distinct("target_id").alias("a_n"), F.min("target_id").alias("a_target"))
    best = scores.where("rank = 1").select(F.col("source_id").alias("id"), F.col("target_id").alias("s_target"), "target", "similarity", "edit_distance", "token_overlap", "score_margin")
    # the first source that found anything gives the name, though another may be the one that verifies
    found = evidence.where("found").groupBy("id").agg(F.max(F.col("lookup_type").isin("exact", "page").cast("int")).alias("verified"), F.min_by(F.struct("source", "canonical", "confidence"), "seq").alias("e"))
    rows = candidates.join(same, "id", "left").join(alias, "id", "left").join(best, "id", "left").join(found, "id", "left")
    merge = F.coalesce(is_spelling_merge(F.col("name"), F.col("target"), F.col("similarity"), F.col("edit_distance"), F.col("token_overlap"), F.col("score_margin")), F.lit(False))

    def row(decision: str, target: Column, name: Column, confidence: Column, reason: Column) -> Column:
        return F.struct(F.lit(decision).alias("decision"), target.cast("string").alias("target_id"), name.cast("string").alias("canonical"), confidence.cast("double").alias("confidence"), reason.alias("reason"))

    none = F.lit(None)
    chosen = (
        F.when(F.col("c_target").isNotNull(), row("merge_into_existing", F.col("c_target"), F.col("c_name"), F.lit(0.99), F.lit("equal to a canonical name")))
        .when(F.col("a_n") == 1, row("alias_to_existing", F.col("a_target"), none, F.lit(0.97), F.lit("equal to an alias")))
        .when(F.col("a_n") > 1, row("needs_human", none, none, F.lit(0.0), F.lit("equal to aliases of several entries")))
        .when(merge, row("merge_into_existing", F.col("s_target"), none, F.least(F.lit(0.96), F.greatest(F.lit(0.90), F.col("similarity"))), F.lit("spelling of a verified name")))
        .when(F.col("verified") == 1, row("keep", none, F.col("e.canonical"), F.greatest(F.lit(0.90), F.col("e.confidence")), F.concat(F.lit("verified by "), F.col("e.source"))))
        .otherwise(row("needs_human", none, none, F.lit(0.0), F.lit("neither verified nor close to a name")))
    )
    return rows.select("id", chosen.alias("x")).select("id", "x.*")


def alias_targets(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, target_id) for decide(): candidates(id, name) with the targets of their name in aliases(name, target_id), of more than two the least and the greatest.

    These tell one target from several, so candidates don't meet every entry that has the alias.
    """
    ends = aliases.where("target_id is not null").groupBy("name").agg(F.array_distinct(F.array(F.min("target_id"), F.max("target_id"))).alias("_ends"))
    return candidates.join(ends, "name").select("id", F.explode("_ends").alias("target_id"))


def review_status(decision: Column, confidence: Column) -> Column:
    return F.when((decision != "needs_human") & (confidence >= AUTO_APPLY), "not_required").otherwise("pending_human")


_FENCED = r"(?s)^\s*```[^\n]*\n(.*?)(?:```\s*)?$"
_DECISION = "decision string, target_id string, canonical string, aliases array<string>, confidence double, reason string"
_DECISIONS = ("keep", "merge_into_existing", "alias_to_existing", "delete", "needs_human")


def unfenced(c: Column) -> Column:
    """JSON without the code fence around it."""
    return F.btrim(F.when(c.rlike(_FENCED), F.regexp_extract(c, _FENCED, 1)).otherwise(c))


def parse_decisions(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """raw(id, raw) answers of a model as decisions; malformed, unknown target or unsure: a person decides."""
    known = ids.select(F.col(ids.columns[0]).cast("string").alias("target_id")).distinct().withColumn("_known", F.lit(True))
    rows = raw.withColumn("d", F.from_json(unfenced(F.col("raw")), _DECISION)).withColumn("target_id", F.col("d.target_id")).join(known, "target_id", "left")
    bad = F.col("d").isNull() | F.col("d.decision").isNull() | ~F.col("d.decision").isin(*_DECISIONS) | F.col("d.confidence").isNull() | ~F.col("d.confidence").between(0, 1)
    unknown = F.col("target_id").isNotNull() & F.col("_known").isNull()
    unsure = F.col("d.confidence") < LLM_LEAST
    human = bad | unknown | unsure
    reason = F.when(bad, "malformed").when(unknown, "unknown target").when(unsure, "unsure").otherwise(F.col("d.reason"))
    return rows.select(
        "id", F.when(human, "needs_human").otherwise(F.col("d.decision")).alias("decision"), F.when(~human, F.col("target_id")).alias("target_id"), F.when(~human, F.col("d.canonical")).alias("canonical"),
        F.when(bad | unknown, 0.0).otherwise(F.col("d.confidence")).alias("confidence"), reason.alias("reason"), F.coalesce(F.when(~human, F.col("d.aliases")), F.array().cast("array<string>")).alias("aliases"),
    )


def hypotheses(tokens: DataFrame, evidence: DataFrame, exact: DataFrame, donors: tuple[str, ...] = ("registry", "page")) -> DataFrame:
    """(token_id, hypothesis, kind, canonical, source, confidence, entry_id).

    tokens(token_id, entry_id, name, match_type, confidence), evidence(token_id, seq, source, found,
    canonical, confidence), exact(canonical, entry_id): which canonical names the catalog has.
    """
    near = tokens.where("entry_id is not null").where((F.col("confidence") >= FUZZY_LEAST) & (F.col("confidence") < EXACT))
    own = near.select("token_id", F.lit("fuzzy").alias("hypothesis"), F.lit("existing").alias("kind"), F.col("name").alias("canonical"), F.concat(F.lit("catalog:"), "match_type").alias("source"), "confidence", "entry_id")
    given = evidence.where(F.col("found") & (F.col("canonical") != "") & F.col("source").isin(*donors)).join(exact, "canonical", "left")
    given = given.select("token_id", F.concat(F.lit("evidence_"), "seq").alias("hypothesis"), F.when(F.col("entry_id").isNotNull(), "existing").otherwise("authoritative").alias("kind"), "canonical", "source", "confidence", "entry_id")
    return own.unionByName(given)


def judge(verdict: Column, choice: Column, confidence: Column, reason: Column, position: Column, kind: Column) -> Column:
    """struct<resolution, trigger> of a model's judgment; kind: of the chosen hypothesis, null if it doesn't exist."""
    from_evidence = F.startswith(choice, F.lit("evidence_"))
    existing = F.coalesce(kind == "existing", F.lit(False))
    junk = (verdict == "junk") & choice.isNull() & (confidence >= JUNK_LEAST)
    matched = existing & (confidence >= MATCH_LEAST) & ((verdict == "matched") | ((verdict == "new_ingredient") & from_evidence))
    new = (verdict == "new_ingredient") & (kind == "authoritative") & (confidence >= NEW_LEAST)
    invalid = ((verdict.isin("matched", "new_ingredient")) & kind.isNull()) | ((verdict == "junk") & choice.isNotNull())
    trigger = (
        F.when((reason == "no parseable result") | F.startswith(reason, F.lit("invalid ")), "llm_response_invalid")
        .when(verdict == "unknown", "llm_unknown")
        .when(invalid, "llm_choice_id_invalid")
        .when((verdict == "matched") & ~existing, "matched_non_catalog_hypothesis")
        .when((verdict == "new_ingredient") & existing & ~from_evidence, "llm_verdict_choice_mismatch")
        .otherwise("llm_confidence_below_threshold")
    )

    def out(resolution: str, why: Column) -> Column:
        return F.struct(F.lit(resolution).alias("resolution"), why.cast("string").alias("trigger"))

    none = F.lit(None)
    return (
        F.when(junk & position.between(1, TOP_POSITIONS), out("pending_human", F.lit("junk_at_top_positions")))
        .when(junk, out("junk", none))
        .when(matched, out("matched", none))
        .when(new, out("new_ingredient", none))
        .otherwise(out("pending_human", trigger))
    )


def trusted(url: Column, domains: Column) -> Column:
    """Whether an https URL's host is one of the domains (array) or under one."""
    h = host(url)
    return F.coalesce(h.isNotNull() & F.exists(domains, lambda d: matches_domain(h, d)), F.lit(False))


def product_verdict(parsed: Column, found: Column, is_trusted: Column, n_online: Column, left: Column, right: Column, renamed: Column) -> Column:
    """Verdict on a product page; thresholds are on the coverages as they are, not as they are rounded for display."""
    return (
        F.when(~parsed, "error").when(~found, "not_found").when(~is_trusted, "untrusted_source").when(n_online == 0, "no_list")
        .when((left >= OVERLAP_LEAST) & (right >= OVERLAP_LEAST), F.when(renamed, "name_resolved").otherwise("verified")).otherwise("divergent")
    )


# What a verdict asks a person to look at.
VERDICT_TRIGGERS = {"not_found": "product_not_found", "no_list": "product_ingredient_list_missing", "untrusted_source": "product_source_untrusted", "name_resolved": "product_name_resolved", "divergent": "divergent_list", "error": "product_result_invalid"}


def final_status(verdict: Column, pending: Column, all_junk: Column) -> Column:
    return F.when((verdict == "verified") & ~pending & ~all_junk, "decision_ready").otherwise("pending_human")


def final_trigger(verdict: Column, pending: Column, all_junk: Column, token_triggers: Column) -> Column:
    named = F.lit("verification_incomplete")
    for v, t in VERDICT_TRIGGERS.items():
        named = F.when(verdict == v, t).otherwise(named)
    return (
        F.when(final_status(verdict, pending, all_junk) == "decision_ready", None).when(all_junk, "all_tokens_junk").when(F.size(token_triggers) > 0, F.get(token_triggers, F.lit(0)))
        .when(verdict == "name_resolved", "product_name_resolved").when(pending, "unresolved_tokens").otherwise(named)
    )


def intake_route(n_tokens: Column, is_exact: Column, same_product: Column, identity: Column, has_match: Column, name_matches: Column) -> Column:
    """Where a submission goes: failed, duplicate, same_name_different_formula, similar_product or verifying."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(n_tokens == 0, "failed").when(yes(is_exact) & yes(same_product), "duplicate").when(identity.isNotNull(), "same_name_different_formula")
        .when(yes(has_match) & ~yes(name_matches), "similar_product").otherwise("verifying")
    )


# What functions of an ingredient say about skin types and concerns.
SKIN_TYPES = {"humectant": ["dry", "all"], "emollient": ["dry", "all"], "exfoliating": ["oily", "acne_prone"], "antioxidant": ["all"], "skin_conditioning": ["all"], "skin_protecting": ["sensitive", "all"]}
CONCERNS = {"exfoliating": ["acne", "texture"], "antioxidant": ["aging"], "skin_lightening": ["hyperpigmentation"], "uv_filter": ["aging"], "anti_seborrheic": ["acne"]}


def tags(functions: Column, table: dict[str, list[str]], present: Column) -> Column:
    """Sorted tags that the functions stand for, unless some are present."""
    lookup = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(functions, lambda f: F.coalesce(F.try_element_at(lookup, f), F.array().cast("array<string>"))))))
    return F.when(F.size(present) > 0, present).otherwise(found)


def approvable(n_unresolved: Column, status: Column) -> Column:
    return (n_unresolved == 0) & (status == "pending_human")


# Verdicts that need a second confirmation.
WARNINGS = ("divergent", "untrusted_source", "not_found", "no_list", "error", "similar_product", "same_name_different_formula")


def needs_confirmation(verdict: Column, resolution: Column, position: Column) -> Column:
    return verdict.isin(*WARNINGS) | ((resolution == "junk") & (position <= TOP_POSITIONS))


def preferred_name(evidence: Column, raw: Column, donors: tuple[str, ...] = ("registry", "page")) -> Column:
    """The canonical name of the first evidence (array of structs) of a donor, else the raw token."""
    return F.coalesce(F.get(F.filter(evidence, lambda e: e["found"] & e["source"].isin(*donors)), F.lit(0))["canonical"], raw)


def _json_object(raw: Column) -> Column:
    """The outermost braces of an answer as a variant; null if they hold no JSON."""
    return F.try_parse_json(F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit("")))


def _field(data: Column, name: str) -> Column:
    return F.try_variant_get(data, f"$.{name}", "variant")


def _has_type(value: Column, *kinds: str) -> Column:
    """Whether a variant is there and of one of these types; VOID is JSON's null."""
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.coalesce(value.isNotNull() & kind.isin(*kinds), F.lit(False))


NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def parse_judgment(raw: Column) -> Column:
    """struct<verdict, choice, confidence, reason> of a model's answer about a token; what isn't as it should be is unknown, with why."""
    data = _json_object(raw)
    verdict, choice, confidence, reason = (_field(data, n) for n in ("verdict", "choice_id", "confidence", "reason"))
    text = lambda v: F.try_variant_get(v, "$", "string")
    number = F.try_variant_get(confidence, "$", "double")

    def out(v: Column, c: Column, n: Column, why: Column) -> Column:
        return F.struct(v.alias("verdict"), c.cast("string").alias("choice"), n.cast("double").alias("confidence"), why.alias("reason"))

    unknown = lambda why: out(F.lit("unknown"), F.lit(None), F.lit(0.0), F.lit(why))
    missing = verdict.isNull() | choice.isNull() | confidence.isNull() | reason.isNull()
    return (
        F.when(data.isNull() | missing, unknown("no parseable result"))
        .when(~_has_type(verdict, "STRING") | ~F.coalesce(text(verdict).isin("matched", "new_ingredient", "junk", "unknown"), F.lit(False)), unknown("invalid verdict"))
        .when(~_has_type(choice, "STRING", "VOID"), unknown("invalid choice_id"))
        .when(~_has_type(reason, "STRING"), unknown("invalid reason"))
        .when(~_has_type(confidence, *NUMBERS) | ~number.between(0, 1), unknown("invalid confidence"))
        .otherwise(out(text(verdict), F.nullif(text(choice), F.lit("")), number, text(reason)))
    )


def parse_finding(raw: Column) -> Column:
    """struct<found, source_name, source_url, product_name, ingredients, reason> of a model's answer about a product; null if it isn't as it should be."""
    data = _json_object(raw)
    found, reason, name, url, product, items = (_field(data, n) for n in ("found", "reason", "source_name", "source_url", "matched_product_name", "online_ingredients"))
    text = lambda v: F.when(_has_type(v, "STRING"), F.try_variant_get(v, "$", "string"))
    each = F.try_variant_get(items, "$", "array<variant>")
    texts = F.transform(F.coalesce(each, F.array().cast("array<variant>")), lambda v: F.btrim(text(v)))
    sound = _has_type(items, "ARRAY") & ~F.exists(texts, lambda t: t.isNull() | (t == ""))
    told = _has_type(found, "BOOLEAN") & _has_type(reason, "STRING")
    yes = F.try_variant_get(found, "$", "boolean")

    def out(f: Column, source: Column, link: Column, n: Column, l: Column) -> Column:
        return F.struct(f.alias("found"), source.cast("string").alias("source_name"), link.cast("string").alias("source_url"), n.cast("string").alias("product_name"), l.cast("array<string>").alias("ingredients"), text(reason).alias("reason"))

    none = F.lit(None)
    named = F.coalesce(F.btrim(text(name)) != "", F.lit(False)) & host(text(url)).isNotNull()
    full = out(yes, F.btrim(text(name)), text(url), F.nullif(F.btrim(text(product)), F.lit("")), texts)
    return F.when(told & ~yes, out(yes, none, none, none, none)).when(told & named & sound, full)


def resolve_tokens(tokens: DataFrame, submissions: DataFrame, entries: DataFrame, choices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tokens, log) after a reviewer's choices(token_id, resolution, entry_id, canonical_name, actor), one for each token.

    tokens(token_id, id, raw_token, resolution, entry_id, canonical_name, match_type, confidence, resolution_source), submissions(id, status).
    A choice counts if its submission waits for a person; a match needs an entry that exists, a new entry a
    name. log(token_id, id, actor, accepted, reason): what was refused, and why.
    """
    known = entries.select(F.col("id").alias("_entry")).distinct()
    asked = choices.select("token_id", F.col("resolution").alias("_to"), F.col("entry_id").alias("_entry"), F.nullif(F.btrim("canonical_name"), F.lit("")).alias("_name"), "actor")
    asked = asked.join(known.withColumn("_known", F.lit(True)), "_entry", "left")
    met = tokens.join(submissions.select("id", F.col("status").alias("_status")), "id", "left").join(asked, "token_id", "left")
    why = (
        F.when(~F.coalesce(F.col("_to").isin("matched", "new_ingredient", "junk"), F.lit(False)), "invalid resolution")
        .when(~F.coalesce(F.col("_status") == "pending_human", F.lit(False)), "not awaiting review")
        .when((F.col("_to") == "matched") & F.col("_known").isNull(), "no such entry")
        .when((F.col("_to") == "new_ingredient") & F.col("_name").isNull(), "no name")
    )
    met = met.withColumn("_why", why).withColumn("_ok", F.col("actor").isNotNull() & F.col("_why").isNull())
    new = {
        "resolution": F.col("_to"), "entry_id": F.when(F.col("_to") == "matched", F.col("_entry")), "canonical_name": F.when(F.col("_to") == "new_ingredient", F.col("_name")),
        "match_type": F.when(F.col("_to") == "matched", F.col("match_type")), "confidence": F.when(F.col("_to") == "matched", F.col("confidence")), "resolution_source": F.lit("human"),
    }
    out = met.select(*[F.when(F.col("_ok"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in tokens.columns])
    return out, met.where("actor is not null").select("token_id", "id", "actor", F.col("_ok").alias("accepted"), F.col("_why").alias("reason"))


def reject_submissions(submissions: DataFrame, refused: DataFrame) -> DataFrame:
    """submissions(id, status, ...) with refused(id) as rejected, where they wait for a person."""
    met = submissions.join(refused.select("id", F.lit(True).alias("_no")).distinct(), "id", "left")
    return met.withColumn("status", F.when(F.col("_no") & (F.col("status") == "pending_human"), "rejected").otherwise(F.col("status"))).select(submissions.columns)
