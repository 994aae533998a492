"""DuckDB statements that state independently what each registered query must return."""

from oracle.eda import EDA
from oracle.inputs import CLEANING, FEATURES, INPUTS
from oracle.profiling import PROFILING
from oracle.quality import QUALITY
from oracle.questions import QUESTIONS
from oracle.star import STAR
from oracle.validation import VALIDATION
from oracle.views import VIEWS

STATEMENTS: dict[str, str] = {**VIEWS, **QUESTIONS, **QUALITY, **PROFILING, **EDA, **VALIDATION, **STAR, **CLEANING, **FEATURES, **INPUTS}
