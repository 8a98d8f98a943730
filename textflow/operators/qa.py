"""Quality checks of translated items by a rule pack: codes of what is wrong, compiled to expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import text
from textflow.operators import dictionary
from textflow.operators.rules import Rules, _triggers, terms_in

#: Phrases of the target language that excuse a forbidden word, and phrases of the source language that ask for
#: two opposite actions at once.
UNBLOCK_MARKS = ("فك", "إلغاء", "إعادة", "رفع")
UNBLOCK_PHRASES = ("فك الحظر", "فك حظر", "إلغاء الحظر", "إعادة فتح", "رفع الحظر")
BLOCK_WORDS, ACTIVATE_WORDS = ("حظر", "إيقاف", "تجميد"), ("تفعيل", "تنشيط")
STOP_PHRASES = ("إلغاء تفعيل", "إيقاف التفعيل")
NEGATED = ("لا يمكن تفعيل", "لا يمكن تنشيط", "لم يتم تفعيل", "غير مفعل", "لا يُفعّل")
ACTIVATE_PHRASES, DEACTIVATE_PHRASES = ("تفعيل", "تنشيط", "إعادة تنشيط", "إعادة تفعيل"), ("إيقاف", "إغلاق", "أغلق", "تعطيل", "إلغاء تفعيل")
BLOCKED = ("terblokir", "terblok", "diblokir", "terblokirnya", "memblokir")
UNBLOCKING = ("membuka blokir", "buka blokir", "bukakan blokir", "pembukaan blokir", "bukakan pemblokiran", "pembukaan pemblokiran", "buka setengah blokir", "bukakan setengah blokir", "bukakan dulu setengah blokir")
TRIAGE_BLOCKED, TRIAGE_UNBLOCKING = ("terblokir", "diblokir", "blokir"), ("membuka blokir", "buka blokir", "pembukaan blokir")
ACTIVATING, DEACTIVATING = ("mengaktifkan", "aktivasi"), ("menonaktifkan", "ditutup", "nonaktif")


def _has(c: Column, words) -> Column:
    return text.any_of([c.contains(w) for w in words])


def forbidden_in(c: Column, word: str) -> Column:
    """Whether a lower-case text has a forbidden word that nothing excuses. A phrase always counts; blocking words are excused
    by marks of unblocking, activating words by stopped or negated activation."""
    if " " in word:
        return c.contains(word)
    excused = [c.contains(p) for p in UNBLOCK_PHRASES if word in p]
    if word in BLOCK_WORDS:
        excused.append(_has(c, UNBLOCK_MARKS))
    if word in ACTIVATE_WORDS:
        excused += [_has(c, STOP_PHRASES), *(c.contains(p) for p in NEGATED if word in p)]
    return c.contains(word) & ~text.any_of(excused)


def allowed_latin(token: Column, source_tokens: Column, rules: Rules) -> Column:
    """Whether a Latin word may stay: it is in the source, or is a listed word or fragment, or either contains the other."""
    low = F.lower(token)
    listed = [w.lower() for w in rules.whitelist]
    near = text.any_of([F.lit(w).contains(low) | low.contains(F.lit(w)) for w in listed])
    exact = low.isin([*listed, *rules.fragments]) if listed or rules.fragments else F.lit(False)
    # named twice, so that the optimizer doesn't move the column's own expression into the lambda, once for each word
    return (source_tokens.isNotNull() & F.array_contains(source_tokens, low)) | exact | near


def hard_qa(items: DataFrame, rules: Rules) -> DataFrame:
    """items (source, target, entities, actions, ...) with hard_pass, hard_errors, hard_warnings, script_ratio, latin_tokens.

    Rules in order: empty target; placeholders left; CJK characters; too small a share of the target script (with a smaller
    least share for redacted sources, and a warning instead if only allowed Latin words are the cause); Latin words;
    missing entities; drift to a confusable one; terms; actions; length; markup. An item passes if it has no error.

    Write the result as a table before filtering it by its codes, or plan with spark.sql.constraintPropagation.enabled=false:
    for a filter right above, the optimizer infers constraints through all rules, which can take a minute."""
    t = F.coalesce("target", F.lit(""))
    src = F.coalesce("source", F.lit(""))
    low_t, low_s = F.lower(t), F.lower(src)
    expected = {f"t{name}": x for name, x in _triggers(rules.terms, "expected").items()} | {f"a{name}": x for name, x in _triggers(rules.actions, "expected").items()}
    items = items.withColumns({
        "_lost": dictionary.lost_names(F.col("entities"), low_t, rules.longest_first, rules.aliases), "_terms": terms_in(src, rules), "_expected": dictionary.groups_in(low_t, expected),
    })
    tokens = items.withColumn("latin_tokens", text.once(text.latin_tokens(t))).withColumn("_source_latin", text.once(F.transform(F.array_union(text.latin_tokens(src), F.flatten(F.transform(F.coalesce("entities", F.array().cast("array<string>")), text.latin_tokens))), F.lower)))
    # the rules on single words need lambdas; they have a projection of their own
    may = lambda x: allowed_latin(x, F.col("_source_latin"), rules)
    tokens = tokens.withColumn("_bad_latin", text.once(F.filter("latin_tokens", lambda x: ~may(x))))
    outside = text.latin_tokens(F.regexp_replace(t, f"[{rules.script}]", ""))
    white = F.aggregate(F.filter(outside, may), F.lit(0), lambda s, x: s + F.length(x))
    masks = F.aggregate(text.redacted_tokens(t), F.lit(0), lambda s, x: s + F.length(x))
    in_script = F.length(F.regexp_replace(t, f"[^{rules.script}]", ""))
    tokens = tokens.withColumn("script_ratio", text.once(F.when(t == "", F.lit(0.0)).otherwise(in_script / F.greatest(F.length(t) - white - masks, F.lit(1)))))
    must = [w for w in rules.must_translate]
    tokens = tokens.withColumn("_latin_errors", text.once(F.transform(F.filter("_bad_latin", lambda x: F.lower(x).isin(must) if must else F.lit(False)), lambda x: F.concat(F.lit("must_translate_latin:"), x))))
    tokens = tokens.withColumn("_latin_warnings", text.once(F.transform(F.filter("_bad_latin", lambda x: ~F.lower(x).isin(must) if must else F.lit(True)), lambda x: F.concat(F.lit("latin_unknown:"), x))))
    least, ratio = text.min_script_ratio(src), F.col("script_ratio")
    residue = [w.lower() for w in rules.residue]
    only_names = (F.size("latin_tokens") > 0) & (F.size("_bad_latin") == 0) & (F.regexp_count(t, F.lit(f"[{rules.script}]+")) >= 4) & ~F.exists("_bad_latin", lambda x: F.lower(x).isin(residue) if residue else F.lit(False))
    shown = F.format_string("%.3f", ratio)
    errors, warnings = [], []
    errors.append(F.when(text.blank(t), "empty_translation"))
    errors.append(F.when(t.rlike(r"<ENT_\d{2}>"), "unrestored_entity_placeholder").when(t.rlike("(?i)<ENT[^>]*>"), "hallucinated_placeholder"))
    errors.append(F.when(t.rlike("[一-鿿]"), "cjk_characters_found"))
    errors.append(F.when((ratio < least) & ~only_names, F.concat(F.lit("script_ratio_too_low:"), shown)))
    warnings.append(F.when((ratio < least) & only_names, F.concat(F.lit("script_ratio_low_but_product_heavy:"), shown)))
    warnings.append(F.when((ratio >= least) & (least < 0.55), F.concat(F.lit("script_ratio_relaxed:"), shown)))
    mid_errors, mid_warnings = [], []
    for name, others in rules.confusions.items():
        for other in others:
            covered = text.any_of([low_t.contains(e.lower()) & F.array_contains("entities", e) for e in rules.entities if other in e])
            drift = F.array_contains("entities", name) & low_t.contains(other.lower()) & ~F.array_contains("entities", other) & ~src.contains(other) & ~low_t.contains(name.lower()) & ~covered
            mid_errors.append(F.when(drift, f"entity_drift:{name}->{other}"))
    for name, spec in rules.terms.items():
        bad = [f.lower() for f in spec.get("forbidden", [])]
        lost = F.array_contains("_terms", name) & ~F.array_contains("_expected", f"t{name}") if spec.get("expected") else F.lit(False)
        mid_warnings.append(F.when(lost, f"term_missing:{name}"))
        mid_errors.append(F.when(lost & text.any_of([forbidden_in(low_t, f) for f in bad]), f"term_confusion:{name}"))
    bare = F.regexp_replace(low_s, r"(?U)\s+", " ")
    both_blocks = _has(bare, BLOCKED) & _has(bare, UNBLOCKING) & _has(t, UNBLOCK_PHRASES)
    plain = F.regexp_replace(F.translate(t, text.TATWEEL, ""), f"[{text.HARAKAT}]", "")
    both_active = _has(low_s, ACTIVATING) & _has(low_s, DEACTIVATING) & _has(plain, ACTIVATE_PHRASES) & _has(plain, DEACTIVATE_PHRASES)
    for name, spec in rules.actions.items():
        bad = [f.lower() for f in spec.get("forbidden", [])]
        on = F.array_contains("actions", name)
        if spec.get("expected"):
            mid_warnings.append(F.when(on & ~F.array_contains("_expected", f"a{name}"), f"action_missing:{name}"))
        if bad:
            excuse, code = (both_blocks, "dual_block_unblock_allowed") if name == "memblokir" else (both_active, "dual_activate_deactivate_allowed") if name in ("activate", "deactivate") else (F.lit(False), "")
            mid_warnings.append(F.when(on & excuse, code))
            mid_errors.append(F.when(on & ~excuse & text.any_of([forbidden_in(low_t, f) for f in bad]), f"action_polarity_error:{name}"))
    length = F.length(t) / F.greatest(F.length(src), F.lit(1))
    last = [F.when(length < 0.35, F.concat(F.lit("maybe_too_short:"), F.format_string("%.2f", length))), F.when(length > 3.5, F.concat(F.lit("maybe_too_long:"), F.format_string("%.2f", length)))]
    none = F.array().cast("array<string>")
    pack = lambda xs: F.array_compact(F.array(*xs)) if xs else none
    named = lambda code, part: F.transform(F.col("_lost")[part], lambda x: F.concat(F.lit(code), x))
    out = tokens.withColumns({
        "hard_errors": text.once(F.concat(pack(errors), "_latin_errors", named("missing_entity:", "missing"), pack(mid_errors), pack([F.when(text.leaked_markup(t), "markdown_or_json_leakage")]))),
        "hard_warnings": text.once(F.concat(pack(warnings), "_latin_warnings", named("entity_translated_ok:", "aliased"), pack(mid_warnings), pack(last))),
    })
    return out.withColumn("hard_pass", F.size("hard_errors") == 0).withColumn("script_ratio", text.rounded(F.col("script_ratio"), 4)).drop("_source_latin", "_bad_latin", "_latin_errors", "_latin_warnings", "_lost", "_terms", "_expected")


def histogram(items: DataFrame, column: str = "hard_errors", only_failed: bool = False) -> DataFrame:
    """Codes (up to the colon) and how often; warnings are usually counted for failed items only."""
    codes = F.when(~F.col("hard_pass"), F.col(column)) if only_failed else F.col(column)
    # an outer explode and a count that skips nulls: a filter would make the optimizer infer constraints through all rules
    rows = items.select(F.explode_outer(codes).alias("code")).groupBy(text.error_code(F.col("code")).alias("code")).agg(F.count("code").alias("n"))
    return rows.where("n > 0")


def pass_rate(items: DataFrame) -> DataFrame:
    n = F.count("*")
    return items.agg(n.alias("items"), F.count_if("hard_pass").alias("passed"), text.rounded(100 * F.count_if("hard_pass") / n, 2).alias("pass_rate"))


def fill_qa(rows: DataFrame, ratio: Column, entities: list[str], phrases: str | None = None) -> DataFrame:
    """rows (original, filled, hint_type) of filled redactions with errors, warnings and status."""
    o, f, hint = F.coalesce("original", F.lit("")), F.coalesce("filled", F.lit("")), F.col("hint_type")
    numeric = hint.isin("pii_card", "pii_phone", "pii_generic")
    long = f.rlike(text.LONG_DIGITS)
    left = text.redacted_count(f)
    errors = [F.when(text.blank(f), "empty_filled"), F.when(left > 0, F.format_string("xxx_remaining:%d/%d", left, text.redacted_count(o))), F.when(ratio < 0.55, F.concat(F.lit("non_xxx_preservation_low:"), F.format_string("%.3f", ratio)))]
    errors += [F.when(long & ~numeric, "pii_shape_long_digit_sequence"), F.when(f.rlike(text.EMAIL), "pii_shape_email_shape")]
    if phrases:
        errors.append(F.when(numeric & f.rlike(phrases) & ~long, "pii_generic_phrase_instead_of_digits"))
    errors.append(F.when((hint == "pii_name") & long, "pii_name_has_long_digits"))
    names = {w: [w] for w in entities}
    missing = F.array_except(dictionary.groups_in(F.lower(o), names), dictionary.groups_in(F.lower(f), names))
    lost = F.transform(missing, lambda x: F.concat(F.lit("missing_entity:"), x))
    out = rows.withColumn("errors", F.concat(F.array_compact(F.array(*errors)), lost)).withColumn("warnings", F.array_compact(F.array(F.when((ratio >= 0.55) & (ratio < 0.72), F.concat(F.lit("non_xxx_preservation_warn:"), F.format_string("%.3f", ratio))))))
    return out.withColumn("status", F.when(F.size("errors") > 0, "failed").when(F.size("warnings") > 0, "warning").otherwise("accepted"))


def semantic_pass(score: Column, preserved: Column, critical: Column, entity: Column) -> Column:
    return (score >= 4) & F.coalesce(preserved, F.lit(False)) & (F.coalesce(F.size(critical), F.lit(0)) <= 0) & (F.coalesce(F.size(entity), F.lit(0)) <= 0)


def not_restored(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)<ENT[^>]*>"), F.lit(False))


def triage(failed: DataFrame, rules: Rules, hollow: bool = True) -> DataFrame:
    """failed (role, source, target, hard_errors) with repair_priority and repair_action; the first case that holds counts."""
    e = F.coalesce("hard_errors", F.array().cast("array<string>"))
    codes = F.transform(e, text.error_code)
    missing = F.transform(F.filter(e, lambda x: x.startswith("missing_entity:")), lambda x: F.substring(x, 16, 1 << 20))
    has = lambda code: F.array_contains(codes, code)
    src, t = F.lower(F.coalesce("source", F.lit(""))), F.coalesce("target", F.lit(""))
    soft = [*rules.aliases]
    only_soft = (F.size(missing) > 0) & F.forall(codes, lambda x: x == "missing_entity") & F.forall(missing, lambda x: x.isin(soft) if soft else F.lit(False))
    core_lost = F.exists(missing, lambda x: text.any_of([F.lower(x).contains(c.lower()) for c in rules.core]))
    dual = _has(src, TRIAGE_BLOCKED) & _has(src, TRIAGE_UNBLOCKING)
    is_hollow = t.rlike(f"(?i){rules.hollow}") if hollow else F.lit(False)
    easy = _has(src, [x.lower() for x in rules.easy_themes])
    low = has("script_ratio_too_low")
    cases = [
        (F.col("role").isin("query", "positive"), "P0"), (only_soft, "RULE"), (has("action_polarity_error") & dual, "RULE"), (has("term_confusion") | has("must_translate_latin"), "P0"),
        (has("unrestored_entity_placeholder") | not_restored(t), "P0"), (core_lost, "P0"), (is_hollow, "P0"), (easy & (F.col("role") == "negative") & (is_hollow | low), "P2_DROP"),
        (has("missing_entity"), "P1"), (has("action_polarity_error"), "P1"), (low, "P2_DROP"),
    ]
    priority = F.when(cases[0][0], cases[0][1])
    for condition, value in cases[1:]:
        priority = priority.when(condition, value)
    out = failed.withColumn("repair_priority", priority.otherwise("P1"))
    return out.withColumn("repair_action", F.when(F.col("repair_priority") == "RULE", "adjust_qa_rule").when(F.col("repair_priority") == "P2_DROP", "drop").otherwise("repair_translation"))
