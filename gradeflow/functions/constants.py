"""Fixed values of the grading domain.

These must stay exactly as they are for results to be right, so they are stated
plainly, in their natural order, and nowhere else.
"""

# -- semesters ---------------------------------------------------------------
SEMESTER_SPELLINGS = {"SECOND_X": "SECOND", "SECOND SEMESTER": "SECOND"}
SEMESTERS = ("FIRST", "SECOND", "SUMMER", "SUMMER2")
TERM_RANKS = {"FIRST": 1, "SECOND": 2, "SUMMER": 3}

# -- school years ------------------------------------------------------------
SCHOOLYEAR_PATTERN = r"(\d{4}-\d{4})"
FIRST_YEAR = 2006

# -- grades ------------------------------------------------------------------
MARKS_WITHOUT_GRADE = ("PASSED", "P", "OG", "F")
DASHES = ("-", "--")
GRADE_SCALE = (
    "1.00", "1.25", "1.50", "1.75", "2.00", "2.25", "2.50", "2.75", "3.00", "4.00", "5.00",
)
STRICT_GRADE = r"^\d+\.\d+$"
LOOSE_GRADE = r"^\d+\.?\d*$"
LOOSE_REEXAM = r"^[0-9]*\.?[0-9]+$"
UNGRADED_AS = 5.0
DROPPED_AS = "0"
PASS_LIMIT = 3.0

# grade -> percentage at the bottom, middle and top of its band; 4.00 has none
PERCENT_BANDS = (
    ("1.00", "98", "99", "100"),
    ("1.25", "94", "95.5", "97"),
    ("1.50", "90", "91.5", "93"),
    ("1.75", "88", "88.5", "89"),
    ("2.00", "85", "86", "87"),
    ("2.25", "83", "83.5", "84"),
    ("2.50", "80", "81", "82"),
    ("2.75", "78", "78.5", "79"),
    ("3.00", "75", "76", "77"),
    ("5.00", "74", "74", "74"),
)

# -- programs ----------------------------------------------------------------
# names that the program list lacks but that belong to an id it holds
PROGRAM_ALIASES = {
    "Master of Arts in Education major in Pagtuturo ng Filipino": 101,
    "Master of Arts in Education major in Filipino": 101,
}

# -- curricula ---------------------------------------------------------------
MISPLACED_TITLES = ("Total Quality Management", "Inorganic and Organic Chemistry")
UNITS_NOT_COUNTED = ("NON", "LAB")
CODE_PARTS_OUT = ("GEd", "OJT", "Litr", "Fili", "NSTP", "PATHFIT")
CODES_OUT = ("ES 101", "PE 101", "PE 102", "PE 103", "PE 104")
MATH_CODE_PART = "MATH"
MATH_PROGRAM = "Bachelor of Secondary Education"
MATH_MAJOR = "Mathematics"
DESCRIPTION_PARTS_OUT = (
    "Supervised Industrial Training",
    "Field Study",
    "Comprehensive Examination",
    "Teaching Internship",
    "Thesis",
    "Capstone",
    "Internship",
    "Comprehensive Exam",
    "Seminar",
    "Review",
    "Colloquium",
)
TYPE_PARTS_OUT = ("OJT",)
COLLEGE_PARTS_OUT = (
    "Integrated School",
    "Graduate School",
    "Expanded Tertiary Education Equivalency and Accreditation Program",
    "College of Law",
    "College of Medicine",
)

# -- forecasts ---------------------------------------------------------------
GRADE_BOUNDS = (1.0, 5.0)
ACCURACY_BANDS = ((5.0, "Excellent"), (10.0, "Good"), (20.0, "Fair"))
ACCURACY_REST = "Poor"
TEST_SHARE = 0.2
FOREST_TREES = 100
FOREST_SEED = 42

# -- input and output --------------------------------------------------------
JDBC_FETCH_SIZE = 10_000
JDBC_BATCH_SIZE = 1_000
COMMITS_RETAINED = 2
