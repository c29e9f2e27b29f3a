"""They have to equal the published ones for results to agree."""

# Sentiment codes and keyword lists.
NEUTRAL, POSITIVE, NEGATIVE = 0, 1, 2
LABEL_NAMES = {0: "NEUTRAL", 1: "POSITIVE", 2: "NEGATIVE"}
POSITIVE_WORDS = [
    "excellent", "amazing", "great", "fantastic", "love", "wonderful", "perfect",
    "satisfied", "good", "best", "recommend",
]
NEGATIVE_WORDS = [
    "bad", "poor", "terrible", "awful", "disappointed", "waste", "horrible", "worst",
    "not worth", "refund", "broken", "defective",
]

# Classes of the served classifier, in index order.
CLASS_NAMES = ["NEGATIVE", "NEUTRAL", "POSITIVE"]

# Text patterns. Written so that Java and RE2 read them alike.
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
HTML_TAG = r"<[^\n]*?>"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"\b(?:\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4,10})\b"
EMAIL_SIMPLE = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
PHONE_SIMPLE = r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b"
SPECIAL_ONLY = r"^[!@#$%^&*()_+\-=\[\]{};:\\|,.<>\/?]+\n?\z"
NON_ASCII = r"[^\x00-\x7F]"
EMOJI_WIDE = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}"
    r"\x{1FA70}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]"
)
EMOJI_NARROW = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FAFF}"
    r"\x{2702}-\x{27B0}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]"
)
# Emoji outside those ranges, and the published forms of sequences: flags, flags by tags, keycaps, and
# characters with a selector or skin tone, joined by U+200D.
EMOJI_OTHER = r"[\x{231A}\x{231B}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{25FB}-\x{25FE}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}]"
EMOJI_ONE = rf"(?:{EMOJI_NARROW}|{EMOJI_OTHER})(?:[\x{{1F3FB}}-\x{{1F3FF}}]|\x{{FE0F}})?"
EMOJI_SEQUENCE = (
    r"[\x{1F1E6}-\x{1F1FF}]{2}|\x{1F3F4}[\x{E0030}-\x{E0039}\x{E0061}-\x{E007A}]+\x{E007F}|[0-9#*]\x{FE0F}?\x{20E3}|"
    rf"{EMOJI_ONE}(?:\x{{200D}}{EMOJI_ONE})*"
)

# Limits of the quality checks.
RANGES = {"rating": (1, 5), "price": (0, None), "year": (2018, 2023), "rating_number": (1, None)}
CRITICAL_COLUMNS = ["asin", "user_id", "rating", "timestamp", "text"]
PII_COLUMNS = ["text", "user_id", "title"]
TEXT_LENGTH = (1, 5000)
TITLE_LENGTH = (1, 200)
OUTLIER_COLUMNS = ["rating", "helpful_vote", "price", "average_rating", "rating_number"]
EXPECTED_VALUES = {
    "main_category": ["Electronics", "Books", "Clothing", "Beauty", "Toys"],
    "verified_purchase": ["Y", "N"],
    "categories": ["Gadget", "Novel", "Apparel", "Cosmetics", "Games"],
}
LAST_REVIEW_DAY = "2023-12-31 00:00:00"

# Aspect seed words and the sentence-level keyword table.
ASPECT_WORDS = {
    "delivery": ["delivery", "arrive", "shipping"],
    "quality": ["quality", "craftsmanship", "durable"],
    "customer_service": ["service", "support", "helpful", "response"],
    "product_design": ["design", "appearance", "look", "style"],
    "cost": ["cost", "price", "value", "expensive", "cheap", "affordable", "$"],
}
DURABILITY_ASPECT = {"durability": ["durability", "wear", "rust"]}
ASPECT_PHRASES = {
    "Product Quality": ["quality", "durability", "build", "craftsmanship", "material"],
    "Usability": ["easy to use", "user-friendly", "install", "setup", "interface"],
    "Customer Service": ["customer service", "support", "response", "help", "assistance"],
    "Pricing": ["price", "cost", "value", "expensive", "cheap"],
    "Shipping and Delivery": ["shipping", "delivery", "arrive", "packaging", "tracking"],
}

# Run configuration.
SAMPLING_FRACTION = 0.01
SEED = 42
TRAINING_MONTHS = 24
TRAINING_SHIFT = 3
SKEW_LIMITS = {
    "text": 0.3, "price": 0.3, "price_missing": 0.1, "helpful_vote": 0.2, "verified_purchase": 0.1,
}
DRIFT_LIMITS = {"text": 0.3, "price_missing": 0.1, "helpful_vote": 0.2, "verified_purchase": 0.1}

# Sentences of the findings report.
REPORT_EMPTY = (
    "According to our records, we couldn’t retrieve any relevant information for your query. "
    "We are continuously working to enhance our data coverage and will provide updates as soon as possible."
)
REPORT_HEAD = "Here’s what we found based on your query. These insights summarize the key aspects:\n\n"
REPORT_MISSING = (
    ": Sentiment data is currently unavailable. "
    "We are working on addressing this gap. Thank you for your patience.\n\n"
)
REPORT_TAIL = (
    "If further details or additional insights are required, please feel free to ask. "
    "Thank you for your continued support!"
)
NO_SUMMARY = "No summary available."
