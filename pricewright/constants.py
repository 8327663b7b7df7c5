"""Numbers, names and formats that define the results."""

CATEGORIES = (
    "Automotive",
    "Electronics",
    "Office_Products",
    "Tools_and_Home_Improvement",
    "Cell_Phones_and_Accessories",
    "Toys_and_Games",
    "Appliances",
    "Musical_Instruments",
)

CATEGORY_MULTIPLIERS = {
    "Automotive": 0.05,
    "Tools_and_Home_Improvement": 0.50,
    "Electronics": 1.00,
    "Toys_and_Games": 1.00,
    "Office_Products": 1.00,
    "Cell_Phones_and_Accessories": 1.00,
    "Musical_Instruments": 1.00,
    "Appliances": 1.00,
}

POUNDS_PER_UNIT = {
    "pounds": 1.0,
    "ounces": 1 / 16,
    "grams": 1 / 453.592,
    "milligrams": 1 / 453592,
    "kilograms": 1 / 0.453592,
}

MIN_PRICE = 0.50
MAX_PRICE = 999.49
MIN_TEXT_LENGTH = 300
PRICE_EPSILON = 1e-9

SEED = 42
PROPORTIONAL_SPLIT_ENDS = (0.9756, 0.9878)
LITE_SPLIT_SIZES = {"train": 20_000, "val": 1_000, "test": 1_000}

EVALUATION_SIZE = 200

QUESTION = "What does this cost to the nearest dollar?"
PRICE_PREFIX = "Price is $"
MAX_SEQUENCE_LENGTH = 128
PROMPT_OVERHEAD = 30
SUMMARY_TOKEN_BUDGET = MAX_SEQUENCE_LENGTH - PROMPT_OVERHEAD
SEQUENCE_CUTOFFS = (64, 96, 128, 160, 192, 256)
HIGH_TRUNCATION_PERCENT = 10.0

VOCABULARY_SIZE = 2_000
IMPORTANT_WORDS = 20

GOOD_ERROR = 50.0
QUICK_TEST_ROWS = 5

FRONTIER_WEIGHT = 0.7
SPECIALIST_WEIGHT = 0.3
ALERT_DISCOUNT = 0.40
BEST_DEALS = 5

PRICE_BIN_WIDTH = 20
PRICE_BIN_COUNT = 49
LENGTH_BIN_COUNT = 50
