"""Class order, limits, word lists, patterns and prompt wording.

Results depend on these exact values, so they live in one place as plain text.
"""

# --- fixed values: classes, in index order 0..4, and the fallback class -----
TARGET_CLASSES = ["feat", "fix", "docs", "refactor", "test"]
FALLBACK_CLASS = "fix"

# --- fixed values: commit types that parse ----------------------------------
COMMIT_TYPES = [
    "feat", "fix", "docs", "style", "refactor", "perf",
    "test", "build", "ci", "chore", "revert",
]

# --- fixed values: column names tried in turn -------------------------------
MESSAGE_COLUMNS = ["message", "msg", "commit_message", "subject"]
DIFF_COLUMNS = ["diff", "patch", "mods", "code_diff", "changes"]
CLEAN_COLUMNS = [
    "message_clean", "diff_text", "files_changed", "lines_added", "lines_removed", "label",
]
NUMERIC_COLUMNS = ["files_changed", "lines_added", "lines_removed"]

# --- fixed values: text limits, in characters -------------------------------
MAX_MESSAGE_CHARS = 500
MAX_DIFF_CHARS = 4000
PREVIEW_CHARS = 280
DIFF_PREVIEW_CHARS = 500
SCAN_SUBJECT_CHARS = 160
RAW_PREVIEW_CHARS = 120
RETRIEVED_SUBJECT_CHARS = 120
FEW_SHOT_SUBJECT_CHARS = 72
SHORT_HASH_CHARS = 10
GENERATE_DIFF_LIMIT = 3500
GENERATE_EXAMPLE_LIMIT = 1500
CLASSIFY_DIFF_LIMIT = 2500
CLASSIFY_EXAMPLE_LIMIT = 1200
TRUNCATION_MARK = "\n...[truncated]"
DIFF_VIEW_LINES = 24
HEAD_SAMPLE_ROWS = 500

# --- fixed values: sampling -------------------------------------------------
SEED = 42
TRAIN_TWENTIETHS = 14  # 0.70
VALIDATION_TWENTIETHS = 3  # 0.15; the rest is the test split

# --- fixed values: tf-idf and token sequences -------------------------------
MAX_TERMS = 30_000
MIN_DOC_FREQ = 2
CHAR_NGRAMS = (3, 5)
MESSAGE_VOCABULARY = 20_000
DIFF_VOCABULARY = 40_000
MESSAGE_SEQUENCE = 48
DIFF_SEQUENCE = 384
MAX_ITERATIONS = 400
INVERSE_REGULARISATION = 1.0

# --- fixed values: models ---------------------------------------------------
AVAILABLE_MODELS = [
    "baseline_tfidf",
    "cnn_text",
    "distilbert",
    "codebert",
    "ensemble",
    "llm:qwen2.5-coder:3b",
    "llm-ensemble",
]
ENSEMBLE_CANDIDATES = ["baseline_tfidf", "cnn_text", "distilbert", "codebert"]
ANSWER_ENSEMBLE_MEMBERS = {"qwen2.5-coder:3b": 0.74, "phi3.5:3.8b-mini-instruct-q4_K_M": 0.67}
BASELINE_BOOST = 2.0
VERIFIER_THRESHOLD = 0.60
AUDIT_FOLDS = 5
RETRIEVED_NEIGHBOURS = 3
MODEL_VERSION = "0.1.0"

# --- fixed values: published scores of the tf-idf classifier ----------------
BASELINE_ACCURACY = 0.7093

# --- fixed values: tool names a chat answer may call ------------------------
TOOL_NAMES = [
    "classify_commit", "generate_commit_message", "scan_repo",
    "classify_repo", "list_models", "list_classes",
]

# --- fixed values: prompt wording -------------------------------------------
EXAMPLE_SEPARATOR = "\n\n---\n\n"

GENERATE_SYSTEM = (
    "You are a senior software engineer writing Conventional Commit messages. "
    "Given a git diff, output ONE single-line commit message in the format: "
    "<type>(<scope>): <subject>. "
    "<type> must be one of: feat, fix, docs, refactor, test. "
    "Keep the subject under 72 characters, imperative mood, lower case, no trailing period. "
    "Do not output explanations, only the commit message line."
)
GENERATE_SYSTEM_REASONING = (
    "You are a senior software engineer writing Conventional Commit messages. "
    "Reason step by step about the diff, then on the LAST line emit the final commit "
    "message in the format: <type>(<scope>): <subject>. "
    "<type> must be one of: feat, fix, docs, refactor, test. "
    "The final line MUST start with the type and a colon."
)
GENERATE_SYSTEM_JSON = (
    "You output ONLY a JSON object with keys "
    '{"type": str, "scope": str, "subject": str}. '
    "type must be one of: feat, fix, docs, refactor, test. "
    "subject is imperative, lower case, < 72 chars, no trailing period. "
    "scope is a short module name or empty string."
)
GENERATE_REASONING_TAIL = (
    "Think step by step:\n"
    "1) What files changed and what kind of change is it "
    "(new code, bug fix, docs, tests, structural)?\n"
    "2) Pick the best Conventional Commit type.\n"
    "3) Write the final one-line commit message on the LAST line, "
    "starting with the type and a colon."
)
GENERATE_JSON_TAIL = (
    "Respond with a single JSON object: "
    '{"type": "...", "scope": "...", "subject": "..."}'
)
CLASSIFY_SYSTEM = (
    "You are a senior software engineer classifying Git commits into one of "
    "the Conventional Commit types: feat, fix, docs, refactor, test. "
    "Given the commit message and diff, respond with EXACTLY one of the "
    "five labels — no explanation, no quotes, no punctuation."
)
CLASSIFY_SYSTEM_JSON = (
    "You classify Git commits into one of: feat, fix, docs, refactor, test. "
    'Respond with a JSON object: {"type": "<one of the labels>"}.'
)
CLASSIFY_JSON_TAIL = 'Respond with: {"type": "<one of feat, fix, docs, refactor, test>"}'

# --- fixed values: what counts as white space and as a line break -----------
# (Unicode white space; line breaks include VT, FF, FS, GS, RS, NEL, LS, PS)
WHITE_SPACE = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Regex classes, read alike by Java and RE2.
SPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LINE_BREAK = r"(?:\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}])"
WORD = r"[\p{L}\p{N}_]{2,}"
PUNCTUATION = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']"""
