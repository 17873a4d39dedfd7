"""Active label, prompt text and reading of a model's answer."""

from pyspark.sql import functions as F

from mendlake.functions.text import py_rstrip, py_strip
from mendlake.schema import group_flag

UNKNOWN = "Unknown"

# Titles of the coarse categories, in order.
TITLES = {
    "memory_management": "Memory Management",
    "invalid_access": "Invalid Access",
    "uninitialized": "Uninitialized",
    "concurrency": "Concurrency",
    "logic_error": "Logic Error",
    "resource_leak": "Resource Leak",
    "security_portability": "Security/Portability",
    "code_quality_performance": "Code Quality/Performance",
}

# Words that decide a category when no title is found, in order.
KEYWORDS = {
    "memory": "Memory Management",
    "invalid": "Invalid Access",
    "access": "Invalid Access",
    "uninitialized": "Uninitialized",
    "uninit": "Uninitialized",
    "concurrent": "Concurrency",
    "race": "Concurrency",
    "thread": "Concurrency",
    "logic": "Logic Error",
    "resource": "Resource Leak",
    "leak": "Resource Leak",
    "security": "Security/Portability",
    "portability": "Security/Portability",
    "quality": "Code Quality/Performance",
    "performance": "Code Quality/Performance",
}

# The prompt text.
PROMPT_HEAD = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:
You are a C++ code error classifier. Analyze the difference between the original (buggy) code and the fixed code, then classify the error into exactly ONE of these categories:
- Memory Management: Issues with malloc/free, new/delete, memory allocation
- Invalid Access: Array out of bounds, null pointer dereference, invalid memory access
- Uninitialized: Using uninitialized variables
- Concurrency: Race conditions, deadlocks, thread safety issues
- Logic Error: Incorrect conditions, off-by-one errors, wrong operators
- Resource Leak: Unclosed files, sockets, unreleased resources
- Security/Portability: Security vulnerabilities, platform-specific issues
- Code Quality/Performance: Style issues, inefficient code

Respond with ONLY the category name, nothing else.

### Input:
Original Code:
```cpp
"""
PROMPT_MIDDLE = """
```

Fixed Code:
```cpp
"""
PROMPT_TAIL = """
```

### Response:
"""


def active_label(groups="labels.groups"):
    """Title of the first true flag in document order, else ``Unknown``."""
    flags = [F.when(group_flag(g, groups), F.lit(title)) for g, title in TITLES.items()]
    return F.coalesce(*flags, F.lit(UNKNOWN))


def prompt(code_original, code_fixed, label=None):
    """Training prompt, or without a label the one for inference."""
    parts = [
        F.lit(PROMPT_HEAD), py_strip(code_original),
        F.lit(PROMPT_MIDDLE), py_strip(code_fixed),
        F.lit(PROMPT_TAIL),
    ]
    if label is None:
        return py_rstrip(F.concat(*parts))
    return F.concat(*parts, label)


def parse_prediction(raw):
    """Category a model's answer names: exact title, contained title, keyword, ``Unknown``."""
    first_line = F.substring_index(py_strip(raw), "\n", 1)
    answer = F.lower(F.btrim(first_line, F.lit(".,!?;:")))
    exact = [F.when(answer == t.lower(), F.lit(t)) for t in TITLES.values()]
    inside = [F.when(answer.contains(t.lower()), F.lit(t)) for t in TITLES.values()]
    words = [F.when(answer.contains(w), F.lit(t)) for w, t in KEYWORDS.items()]
    return F.coalesce(*exact, *inside, *words, F.lit(UNKNOWN))
