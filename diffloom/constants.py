"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour being reproduced
(word lists, marker strings, status names, extension lists, repository tables). They are
written out plainly, in their natural order, and are data, not logic.
"""

# --- fixed values: closing keywords that mark an issue as resolved by a pull request ---
CLOSING_KEYWORDS = [
    "close", "closes", "closed",
    "fix", "fixes", "fixed",
    "resolve", "resolves", "resolved",
]

# --- fixed values: test statuses ---
FAILED = "FAILED"
PASSED = "PASSED"
SKIPPED = "SKIPPED"
ERROR = "ERROR"
XFAIL = "XFAIL"
TEST_STATUSES = [FAILED, PASSED, SKIPPED, ERROR, XFAIL]

# --- fixed values: gold test categories ---
FAIL_TO_PASS = "FAIL_TO_PASS"
PASS_TO_PASS = "PASS_TO_PASS"
FAIL_TO_FAIL = "FAIL_TO_FAIL"
PASS_TO_FAIL = "PASS_TO_FAIL"

# --- fixed values: resolution outcomes ---
RESOLVED_FULL = "RESOLVED_FULL"
RESOLVED_PARTIAL = "RESOLVED_PARTIAL"
RESOLVED_NO = "RESOLVED_NO"

# --- fixed values: evaluation modes ---
PASS_AND_FAIL = "pass_and_fail"
FAIL_ONLY = "fail_only"
FAIL_ONLY_REPOS = ["chartjs/Chart.js", "processing/p5.js", "markedjs/marked"]

# --- fixed values: harness log markers ---
APPLY_PATCH_FAIL = ">>>>> Patch Apply Failed"
APPLY_PATCH_PASS = ">>>>> Applied Patch"
INSTALL_FAIL = ">>>>> Init Failed"
INSTALL_PASS = ">>>>> Init Succeeded"
INSTALL_TIMEOUT = ">>>>> Init Timed Out"
RESET_FAILED = ">>>>> Reset Failed"
TESTS_ERROR = ">>>>> Tests Errored"
TESTS_FAILED = ">>>>> Some Tests Failed"
TESTS_PASSED = ">>>>> All Tests Passed"
TESTS_TIMEOUT = ">>>>> Tests Timed Out"
START_TEST_OUTPUT = ">>>>> Start Test Output"
END_TEST_OUTPUT = ">>>>> End Test Output"
# a log holding any of these is "not applied"
BAD_LOG_MARKERS = [APPLY_PATCH_FAIL, RESET_FAILED, TESTS_ERROR, TESTS_TIMEOUT]

# --- fixed values: file suffixes that are not test files (note: "csv" has no dot) ---
NON_TEST_EXTS = [
    ".json", ".png", "csv", ".txt", ".md", ".jpg", ".jpeg", ".pkl", ".yml", ".yaml", ".toml",
]

# --- fixed values: media extensions for the statement gate ---
IMAGE_EXTENSIONS = [
    ".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tiff", ".svg", ".webp", ".ico", ".heif",
    ".bpg", ".avif",
]
VIDEO_EXTENSIONS = [".mp4", ".avi", ".mkv", ".mov", ".wmv", ".flv", ".webm", ".mpeg"]

# --- fixed values: markers of a message check in a test patch ---
PYTEST_MESSAGE_MARKERS = ["pytest.raises", "pytest.warns", "pytest.deprecated_call"]
DJANGO_MESSAGE_MARKERS = ["assertOutput", "assertRaises", "checks.Error"]

# --- fixed values: words marking a test path ---
TEST_PATH_WORDS = ["test", "tests", "testing"]            # word form (retrieval corpora)
TEST_PATH_SUBSTRINGS = ["test", "tests", "e2e", "testing"]  # substring form (patch split)

# --- fixed values: log dialect per repository ---
PYTEST = "pytest"
PYTEST_OPTIONS = "pytest_options"
PYTEST_V2 = "pytest_v2"
DJANGO = "django"
SEABORN = "seaborn"
SYMPY = "sympy"
MATPLOTLIB = "matplotlib"
CALYPSO = "calypso"
CHART_JS = "chart_js"
MARKED = "marked"
P5JS = "p5js"
REACT_PDF = "react_pdf"
REPO_DIALECT = {
    "astropy/astropy": PYTEST_V2,
    "django/django": DJANGO,
    "marshmallow-code/marshmallow": PYTEST,
    "matplotlib/matplotlib": MATPLOTLIB,
    "mwaskom/seaborn": SEABORN,
    "pallets/flask": PYTEST,
    "psf/requests": PYTEST_OPTIONS,
    "pvlib/pvlib-python": PYTEST,
    "pydata/xarray": PYTEST,
    "pydicom/pydicom": PYTEST_OPTIONS,
    "pylint-dev/astroid": PYTEST,
    "pylint-dev/pylint": PYTEST_OPTIONS,
    "pytest-dev/pytest": PYTEST,
    "pyvista/pyvista": PYTEST,
    "scikit-learn/scikit-learn": PYTEST_V2,
    "sqlfluff/sqlfluff": PYTEST,
    "sphinx-doc/sphinx": PYTEST_V2,
    "sympy/sympy": SYMPY,
    "Automattic/wp-calypso": CALYPSO,
    "chartjs/Chart.js": CHART_JS,
    "markedjs/marked": MARKED,
    "processing/p5.js": P5JS,
    "diegomura/react-pdf": REACT_PDF,
}

# --- fixed values: django-dialect pass suffixes and fixed sentences ---
DJANGO_PASS_SUFFIXES = [" ... ok", " ... OK", " ...  OK"]
DJANGO_VERSION_SENTENCE = "--version is equivalent to version"
DJANGO_MIGRATION_PREFIX = "Applying sites.0002_alter_domain_unique...test_no_migrations"

# --- fixed values: matplotlib-dialect literal replacements ---
MATPLOTLIB_REPLACEMENTS = [("MouseButton.LEFT", "1"), ("MouseButton.RIGHT", "3")]

# --- fixed values: the one repository whose test directives are module paths ---
DJANGO_REPO = "django/django"

# --- fixed values: report schema version ---
REPORT_SCHEMA_VERSION = 2

# --- fixed values: padding label for training targets ---
IGNORE_LABEL = -100
