"""Row-level column expressions (all built-in, codegen-friendly; no UDFs).

Each function takes and returns ``Column``s so it can sit inside any
projection, filter or aggregate of a table job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
PRIORITY_CODES = {"critical": 0, "high": 1, "medium": 2, "low": 3}
STATUS_CODES = {"pending": "open", "in-progress": "in_progress", "in_progress": "in_progress",
                "completed": "closed", "done": "closed"}
TASK_ID_PATTERNS = [r"(bd-\d+)", r"(BEAD-\d+)", r"(bead-\d+)"]
PASSING_CONCLUSIONS = ["SUCCESS", "SKIPPED", "NEUTRAL"]
MERGEABLE_LABELS = {"MERGEABLE": "✅ Yes", "CONFLICTING": "❌ Conflicts", "UNKNOWN": "⏳ Checking..."}
REVIEW_STATE_MARKS = {"APPROVED": "✅", "CHANGES_REQUESTED": "❌", "COMMENTED": "💬",
                      "PENDING": "⏳", "DISMISSED": "🚫"}
REVIEW_STATE_OTHER = "•"
NO_TEST_RUNNER = "# No test runner detected - verify manually or add tests"
COMPLETION_PROMISE = "<promise>COMPLETE</promise>"
LOOP_COMMIT_PATTERN = r"^ralph: iteration (\d+) - (.*)$"
ERROR_HEADINGS = {"go build": "Go build errors:", "go vet": "Go vet issues:",
                  "tsc": "TypeScript errors:", "py_compile": "Python syntax error"}
# ---------------------------------------------------------------------------


def _lookup(c: Column, mapping: dict, default) -> Column:
    """CASE c WHEN k THEN v ... ELSE default (mapping is a small fixed dict)."""
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v)))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def slugify(c: Column) -> Column:
    """lower, runs of non [a-z0-9] -> '-', strip '-' at both ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def priority_code(c: Column) -> Column:
    """critical/high/medium/low (any case) -> 0..3; anything else -> 2."""
    return _lookup(F.lower(c), PRIORITY_CODES, 2).cast("int")


def status_code(c: Column) -> Column:
    """File status -> graph status; unknown or missing -> open."""
    return _lookup(F.lower(c), STATUS_CODES, "open")


def phase_label(phase_name: Column) -> Column:
    """Label of a phase: drop 'Phase ', keep text before ':', slugify."""
    return slugify(F.substring_index(F.replace(phase_name, F.lit("Phase "), F.lit("")), ":", 1))


def flat_label(task_id: Column) -> Column:
    """Label in the flat shape: id text before the first '-', else 'default'."""
    return F.when(F.instr(task_id, "-") > 0, F.substring_index(task_id, "-", 1)).otherwise(F.lit("default"))


def extract_task_id(branch: Column, patterns=None) -> Column:
    """First pattern (in list order, unanchored) that matches wins."""
    pats = patterns or TASK_ID_PATTERNS
    return F.coalesce(*[F.nullif(F.regexp_extract(branch, p, 1), F.lit("")) for p in pats], F.lit(""))


def parse_list_line(line: Column) -> tuple[Column, Column]:
    """(id, title) of a list line 'bd-1  Title  [status]'; id-only fallback."""
    t = F.trim(line)
    full = r"^(bd-\d+)\s+(.+?)(?:\s+\[.+\])?$"
    lid = F.regexp_extract(t, full, 1)
    title = F.trim(F.regexp_extract(t, full, 2))
    simple = F.regexp_extract(t, r"^(bd-\d+)", 1)
    return (F.when(lid != "", lid).otherwise(simple),
            F.when(lid != "", title).otherwise(F.lit("")))


def show_field(block: Column, key: str) -> Column:
    """Trimmed value of the first line starting with '<key>:' in a text block."""
    return F.trim(F.regexp_extract(block, rf"(?m)^{key}:([^\n]*)", 1))


def count_lines(c: Column) -> Column:
    """0 for empty text, else number of lines of the whitespace-trimmed text."""
    trimmed = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "\n"))).cast("bigint")


def truncate_lines(c: Column, n: int) -> Column:
    """Keep the first n lines; append '... (k more lines)' when cut."""
    parts = F.split(c, "\n")
    k = F.size(parts) - F.lit(n)
    return F.when(F.size(parts) <= n, c).otherwise(
        F.concat(F.array_join(F.slice(parts, 1, n), "\n"),
                 F.lit("\n... ("), k.cast("string"), F.lit(" more lines)")))


def sanitize(c: Column) -> Column:
    """Shell-safe text: ( -> [, ) -> ], backtick -> ', $ removed."""
    return F.translate(c, "()`$", "[]'")


def review_thread(task_id: Column) -> Column:
    return F.concat(F.coalesce(F.nullif(task_id, F.lit("")), F.lit("<task-id>")), F.lit("-review"))


def check_category(status: Column, conclusion: Column) -> Column:
    """pending / passing / failing; case-sensitive like the source."""
    return (F.when(F.coalesce(status, F.lit("")) != "COMPLETED", F.lit("pending"))
            .when(conclusion.isin(*PASSING_CONCLUSIONS), F.lit("passing"))
            .otherwise(F.lit("failing")))


def mergeable_label(c: Column) -> Column:
    return _lookup(F.upper(c), MERGEABLE_LABELS, c)


def review_state_mark(c: Column) -> Column:
    return _lookup(F.upper(c), REVIEW_STATE_MARKS, REVIEW_STATE_OTHER)


def quoted_body(body: Column) -> Column:
    """Every line of the body prefixed with '> '."""
    return F.array_join(F.transform(F.split(body, "\n"), lambda l: F.concat(F.lit("> "), l)), "\n")


def comment_location(path: Column, line: Column) -> Column:
    return F.when(F.coalesce(line, F.lit(0)) > 0, F.concat(path, F.lit(":"), line.cast("string"))).otherwise(path)


def format_status(staged: Column, modified: Column, untracked: Column) -> Column:
    """'n staged, n modified, n untracked' with zero parts left out."""
    return F.concat_ws(", ",
                       F.when(staged > 0, F.concat(staged.cast("string"), F.lit(" staged"))),
                       F.when(modified > 0, F.concat(modified.cast("string"), F.lit(" modified"))),
                       F.when(untracked > 0, F.concat(untracked.cast("string"), F.lit(" untracked"))))


def thread_kind(thread_id: Column) -> tuple[Column, Column]:
    """(task id, kind) from '<task>[-review|-blocked|-handoff]'; plain -> work."""
    pat = r"^(.+?)(?:-(review|blocked|handoff))?$"
    kind = F.regexp_extract(thread_id, pat, 2)
    return F.regexp_extract(thread_id, pat, 1), F.when(kind == "", F.lit("work")).otherwise(kind)


# Subject prefixes of the coordination protocol, checked in this order.
MESSAGE_KINDS = [
    ("Starting", "starting"), ("Progress", "progress"), ("BLOCKED", "blocked"),
    ("COMPLETE", "complete"), ("Review Request", "review_request"),
    ("Review In Progress", "review_claimed"), ("Review Complete", "review_complete"),
    ("Feedback Addressed", "feedback_addressed"), ("Re-Review", "re_review"),
]


def message_kind(subject: Column) -> Column:
    out = None
    for prefix, kind in MESSAGE_KINDS:
        cond = F.startswith(subject, F.lit(prefix))
        out = F.when(cond, F.lit(kind)) if out is None else out.when(cond, F.lit(kind))
    return out.otherwise(F.lit("other"))


# Review feedback categories -> priority (lower = sooner); praise needs no action.
FEEDBACK_PRIORITY = {"blocking": 0, "suggestion": 1, "question": 2, "nitpick": 3, "praise": 4}


def feedback_priority(category: Column) -> Column:
    return _lookup(category, FEEDBACK_PRIORITY, None).cast("int")
