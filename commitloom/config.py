"""Parameters. Word lists, weights, limits, patterns and prompt texts are fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# Heuristic weights.
WEIGHTS = {
    "base": 20,
    "signed_off": 15,
    "reviewed_by": 20,
    "acked_by": 10,
    "fixes_tag": 20,
    "long_message": 10,
    "has_rationale": 15,
    "optimal_size": 10,
    "too_many_files": -30,
    "trivial_subject": -50,
}
# Word lists.
RATIONALE_WORDS = ("because", "since", "due to", "reason", "trigger", "cause", "fixes", "resolves")
TRIVIAL_WORDS = ("typo", "whitespace", "formatting", "cleanup", "unused", "indent", "style")
MERGE_PHRASES = ("Merge branch", "Merge pull request", "Merge commit", "Merge remote")
# Flag bit, tag and pattern, in the order in which tags are listed.
TAG_RULES = (
    (1, "security", r"\b(CVE-\d{4}-\d+|overflow|use-after-free|uaf|double-free|bounds check|sanitizer|leak|vulnerability|exploit|syzkaller|locking|race condition)\b"),
    (2, "performance", r"\b(optimize|performance|speed up|latency|throughput|cache|alloc|memory usage|cpu usage|overhead|fast path|bottleneck)\b"),
    (4, "refactor", r"\b(refactor|cleanup|simplify|restructure|rename|move|remove|delete)\b"),
    (8, "documentation", r"\b(doc|comment|typo|spelling|warning|readme)\b"),
    (16, "driver", r"(drivers/|arch/|soc/|firmware/|platform/|usb:|net:|scsi:|drm:|media:|sound:)"),
    (32, "backport", r"(cherry picked from commit|backport|upstream commit)"),
    (64, "revert", r'^Revert "'),
)
SUBJECT_TAGS = ("driver", "revert")  # looked for in the subject, the others in subject and body
# Paths.
BINARY_EXTENSIONS = (".png", ".jpg", ".jpeg", ".gif", ".ico", ".bmp", ".bin", ".o", ".ko", ".so", ".a", ".fw", ".dts", ".dtb", ".pdf", ".doc", ".docx", ".tar", ".gz", ".bz2", ".xz", ".zip")
EXCLUDED_PREFIXES = ("Documentation/", "tools/testing/")
TWO_LEVEL_ROOTS = ("kernel", "mm", "fs", "net", "block", "ipc", "security", "crypto", "drivers", "arch")
ONE_LEVEL_ROOTS = ("include", "tools", "scripts", "Documentation")
CODE_EXTENSIONS = (".c", ".h")
# maintainers' weights.
MAINTAINERS = {
    "torvalds@linux-foundation.org": 100,
    "gregkh@linuxfoundation.org": 95,
    "akpm@linux-foundation.org": 90,
    "davem@davemloft.net": 85,
    "tglx@linutronix.de": 85,
    "mingo@kernel.org": 85,
    "peterz@infradead.org": 80,
    "viro@zeniv.linux.org.uk": 80,
    "hch@lst.de": 75,
    "axboe@kernel.dk": 75,
}
# Text limits, in code points.
MIN_INSTRUCTION = MIN_INPUT = MIN_OUTPUT = 50
MAX_OUTPUT = 8000
MAX_PROMPT_INSTRUCTION = 15000
INPUT_CUT, OUTPUT_CUT = 8000, 12000
TRUNCATED_INPUT = "\n/* ... truncated ... */"
TRUNCATED_DIFF = "\n... [TRUNCATED]"
# Beginnings of functions, matched at the start of a stripped line.
FUNCTION_STARTS = (
    r"^(?:static\s+)?(?:inline\s+)?(?:const\s+)?[\w\s\*]+\s+\w+\s*\([^)]*\)\s*{?",
    r"^(?:static\s+)?(?:inline\s+)?[\w\s\*]+\s*\(\s*\*\s*\w+\s*\)\s*\([^)]*\)\s*{?",
    r"^(?:virtual\s+)?~?\w+\s*\([^)]*\)\s*{?",
    r"^(?:virtual\s+)?[\w\s\*]+\s+operator\s*[\+\-\*\/\=\<\>]+\s*\([^)]*\)\s*{?",
)
# Prompts and templates.
SYSTEM_PROMPT = "You are a Linux kernel developer. Given a commit message describing a bug fix, feature, or improvement, and the relevant source code context, generate the appropriate kernel patch."
TEMPLATES = {
    "review": ("You are an expert Linux kernel code reviewer. Analyze patches for bugs, style issues, and potential problems.", "Review this Linux kernel patch and identify any issues:\n\n", "Analysis of commit '"),
    "optimize": ("You are a Linux kernel performance optimization expert. Identify and implement performance improvements.", "Optimize this kernel code for better performance:\n\n", ""),
    "security": ("You are a Linux kernel security expert. Identify and fix security vulnerabilities.", "Analyze this kernel code for security vulnerabilities:\n\n", "Security fix applied:\n\n"),
    "bugfix": ("You are a Linux kernel debugging expert. Given buggy code, produce the correct fix.", "This kernel code has a bug. Fix it:\n\n", ""),
    "explain": ("You are a Linux kernel educator. Explain kernel code changes clearly.", "Explain what this kernel patch does and why:\n\n", ""),
}
REVIEWER_SYSTEM = "You are an expert code reviewer evaluating commits for AI training quality."
REVIEWER_PARTS = ("Rate this Linux kernel commit for training quality.\n\n**Commit Message:**\n", "\n\n**Code Diff:**\n", "\n\nProvide a score (1-5) and detailed reasoning.")
SCORING_PARTS = (
    "You are an expert code reviewer evaluating Linux kernel commits for training a code generation AI.\n\n"
    "Rate this commit's quality for AI training on a scale of 1-5:\n\n**Scoring Criteria:**\n"
    "- **5 (Excellent)**: Clear problem statement, detailed explanation of WHY, shows best practices, educational value\n"
    "- **4 (Good)**: Clear message, logical fix, explains rationale, minor gaps in explanation\n"
    "- **3 (Average)**: Understandable change, basic explanation, some educational value\n"
    "- **2 (Below Average)**: Unclear message or trivial change, limited learning value\n"
    "- **1 (Poor)**: No explanation, confusing, or purely cosmetic change\n\n**Commit Message:**\n",
    "\n**Code Context (before change):**\n",
    "\n**Code Diff:**\n",
    "\n\n**Evaluate:**\n1. Does the commit message clearly explain WHAT changed and WHY?\n2. Is the code change logical and well-structured?\n"
    "3. Does it demonstrate good coding practices?\n4. Would this help an AI learn to write better code?\n\n"
    'Respond ONLY with valid JSON:\n{"score": <1-5>, "reason": "<one detailed sentence explaining your score>"}\n',
)
REWRITE_PARTS = (
    "You are a senior Linux kernel maintainer.\nThe following commit contains a valid code fix but has a poor or lazy commit message.\n\n"
    "Your task is to REWRITE the commit message to meet strict Linux kernel standards.\nExplain WHAT changed and WHY, considering the code context and diff.\n\n"
    '**Standards:**\n- Subject line: "subsystem: short summary" (max 75 chars)\n- Body: Detailed explanation of the problem and the fix.\n'
    "- Do NOT make up facts. Stick to what is visible in the code.\n\n**Original Message (for reference):**\n",
    "\n\n**Code Context:**\n",
    "\n\n**Code Diff:**\n",
    '\n\nRespond ONLY with the rewritten commit message (Subject + Body). Do not include "Here is the rewritten message" or other filler.',
)
# Words that show an answer addresses its category, and marks of style.
CATEGORY_WORDS = {
    "Bug Fix": ("copy", "before", "free", "fix"),
    "Memory Leak": ("kfree", "free", "goto", "err", "cleanup"),
    "Race Condition": ("lock", "unlock", "spin_lock", "mutex"),
    "NULL Pointer": ("if (!", "NULL", "check", "!desc"),
    "Locking": ("rcu_read_lock", "rcu_read_unlock", "RCU"),
}
STYLE_MARKS = ("#include", "static ", "struct ", "return ", "\t")


@dataclass(frozen=True)
class ExportConfig:
    """Of the standard export; None or 0 leaves a condition out."""

    min_lines: int = 5
    max_lines: int = 500
    exclude_merges: bool = True
    include_subsystems: tuple[str, ...] = ()
    exclude_subsystems: tuple[str, ...] = ()
    min_heuristic: float = 0
    min_ai: float = 0
    include_tags: tuple[str, ...] = ()
    exclude_tags: tuple[str, ...] = ()
    sample: float | None = None
    seed: int = 42
    full_code: bool = False
    limit: int | None = None


@dataclass(frozen=True)
class Tier:
    """A quality tier: least heuristic score, least model score (None: not asked for), reasoning asked for, most records."""

    name: str
    min_heuristic: float
    min_ai: float | None = None
    reasoning: bool = False
    limit: int | None = None
    strict: bool = True
    phrase: str | None = None


TIERS = (
    Tier("premium", 90, limit=10_000),
    Tier("high_quality", 70, limit=50_000),
    Tier("standard", 50, limit=100_000),
    Tier("premium_reasoning", 90, 0, True, 5_000),
    Tier("high_reasoning", 70, 0, True, 5_000),
)
HUB_TIERS = (
    Tier("super_ultra", 0, 1, True, None, False, "highly valuable for an AI"),
    Tier("premium_score", 90, 4, False, None, False),
    Tier("high_score", 70, 4, False, None, False),
    Tier("premium_reasoning", 90, 4, True, None, False),
    Tier("high_reasoning", 70, 3, True, None, False),
)


PREP_TIERS = (
    Tier("premium", 90, limit=5_000),
    Tier("premium_ai", 0, 4, True, 2_000),
    Tier("high_quality", 70, limit=20_000),
)


@dataclass(frozen=True)
class ExtractConfig:
    max_diff: int = 100_000
    include_binary: bool = False
    include_extensions: tuple[str, ...] | None = None
    exclude_prefixes: tuple[str, ...] = field(default=EXCLUDED_PREFIXES)
