"""Oracle statement of the prompt table; the wording is shared as constant text."""

from __future__ import annotations

from voxsift.operators.drafting import _ANSWER, _ASK


def _prompt(stage: str, subject: str) -> str:
    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    return f"{literal(_ASK[stage])} || chr(10) || chr(10) || {subject} || chr(10) || chr(10) || {literal(_ANSWER[stage])}"


def prompts_statement(context: str, confidence: str, drawn_title: str) -> str:
    source = (
        "'Source: ' || source_type || ' (ID: ' || source_id || ')' || chr(10) || "
        "'Feedback:' || chr(10) || text"
    )
    names = ["source_id", "source_type", "title", "description", "category", "priority", "technical_details"]
    ticket = "concat_ws(chr(10), " + ", ".join(f"'  {n}: ' || {n}" for n in names) + ")"
    hint = """CASE WHEN length(title) < 10 THEN chr(10) || chr(10)
      || 'PREVIOUS ATTEMPT FAILED quality review. Fix these issues:' || chr(10)
      || '  - Title too short (' || length(title) || ' chars, min 10)' ELSE '' END"""
    draft, critic = _prompt("draft", context), _prompt("critic", ticket)
    again = _prompt("draft", "(" + context + " || " + hint + ")")
    reached = (
        f"(SELECT * REPLACE (CASE WHEN {drawn_title} % 20 < 3 THEN 'Fix bug' ELSE title END AS title) FROM drafts) "
        f"WHERE {confidence} >= 0.7"
    )
    return f"""
      SELECT source_id, 'classifier' AS stage, 1 AS attempt, {_prompt('classifier', source)} AS prompt FROM states
      UNION ALL SELECT source_id, 'bug', 1, {_prompt('bug', 'text')} FROM {reached} AND category = 'Bug'
      UNION ALL SELECT source_id, 'feature', 1, {_prompt('feature', 'text')} FROM {reached} AND category = 'Feature Request'
      UNION ALL SELECT source_id, 'draft', 1, {draft} FROM {reached}
      UNION ALL SELECT source_id, 'critic', 1, {critic} FROM {reached}
      UNION ALL SELECT source_id, 'draft', 2, {again} FROM {reached} AND length(title) < 10
      UNION ALL SELECT source_id, 'critic', 2, {critic} FROM {reached} AND length(title) < 10"""
