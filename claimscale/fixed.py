"""Fixed values.

They decide which rows and which numbers come out, so they are kept here as
plain text and every function that uses one takes it as a default argument.
"""

# --- fixed values: topic labels, in topic order ------------------------------
TOPIC_LABELS = [
    {"topic_id": 0, "topic": "S", "policy": "ethics"},
    {"topic_id": 1, "topic": "S", "policy": "community"},
    {"topic_id": 2, "topic": "S", "policy": "workplace"},
    {"topic_id": 3, "topic": "G", "policy": "governance"},
    {"topic_id": 4, "topic": "E", "policy": "environment"},
]
TOPIC_SCHEMA = "topic_id int, topic string, policy string"
PILLARS = ["E", "G", "S"]

# --- fixed values: thresholds ------------------------------------------------
MIN_STATEMENT_CHARS = 255
MIN_PROBABILITY = 0.8
LATEST_PER_TICKER = 99
THEME_PREFIX = "UNGP"
PREVIEW_CHARS = 5000
MODEL_SEED = 42

# --- fixed values: scores from which a learned sentence rule counts (published 2006) ---
ABBREVIATION_SCORE = 0.3
STARTER_SCORE = 30
PAIR_SCORE = 7.88

# --- fixed values: paragraph patterns, in the order of their use --------------
# Java syntax; (?d) makes "." and "$" treat only \n as the end of a line.
HEADER_NUMBER = r"(?d)^\s?\d+(.*)$"
HYPHEN = r"\s?-\s?"
PUNCTUATION = r"\s?([,:;\.])"
LONG_NUMBER = r"\d{5,}"
HOST = r"((http|https)\:\/\/)?[a-zA-Z0-9\.\/\?\:@\-_=#]+\.([a-zA-Z]){2,6}([a-zA-Z0-9\.\&\/\?\:@\-_=#])*"
SPACES = r"\s+"
POINTS = r"\.+"

# --- fixed values: other patterns --------------------------------------------
NON_PRINTABLE = r"[^\x20-\x7E\t\n\r\x0B\f]"
WHITE_SPACE = " \t\n\r\x0b\x0c"
TITLE_TAG = "PAGE_TITLE"

# --- rules of this library ----------------------------------------------------
# A line starts a new paragraph when the line before it ends with a full stop
# and it does not itself begin with a space.
PARAGRAPH_BREAK = r"\n(?<=\.\n)(?! )"
# A host name can only start where its run of characters starts; saying so keeps
# the search linear in runs of any length.
HOST_START = r"(?<![a-zA-Z0-9./?:@\-_=#])"
HOST_HINT = r"\.[a-zA-Z]{2}"
# HYPHEN, PUNCTUATION, SPACES and POINTS also match where the replacement changes
# nothing.  These match only where it does, and leave the same text behind.
HYPHEN_GAP = r"\s-\s?|-\s"
PUNCTUATION_GAP = r"\s([,:;\.])"
SPACE_RUN = r"\s{2,}|[^\S ]"
POINT_RUN = r"\.{2,}"
SENTENCE_BREAK = r"(?<=[.!?])\s+"
PAGE_BREAK = "\f"
FILE_KEY = r"([\w-]+)\.[^./]*$"
TOKEN_BREAK = r"[^\p{L}\p{M}\p{N}]+"
MIN_TOKEN_CHARS = 4

# --- fixed values: suffix rules of English stems (published 1980) ---------------
# Per step: (suffix, what takes its place, condition on what is left of the word).
# Conditions: "" none, "m0" more than no vowel-consonant sequence, "m1" more than
# one, "v" a vowel, "st" more than one sequence and s or t at the end.
# Of a step the longest suffix of a word decides, whether its condition holds or not.
STEM_PLURALS = [("sses", "ss", ""), ("ies", "i", ""), ("ss", "ss", ""), ("s", "", "")]
STEM_STEP_2 = [
    ("ational", "ate", "m0"), ("tional", "tion", "m0"), ("enci", "ence", "m0"),
    ("anci", "ance", "m0"), ("izer", "ize", "m0"), ("abli", "able", "m0"),
    ("alli", "al", "m0"), ("entli", "ent", "m0"), ("eli", "e", "m0"), ("ousli", "ous", "m0"),
    ("ization", "ize", "m0"), ("ation", "ate", "m0"), ("ator", "ate", "m0"),
    ("alism", "al", "m0"), ("iveness", "ive", "m0"), ("fulness", "ful", "m0"),
    ("ousness", "ous", "m0"), ("aliti", "al", "m0"), ("iviti", "ive", "m0"),
    ("biliti", "ble", "m0"),
]
STEM_STEP_3 = [
    ("icate", "ic", "m0"), ("ative", "", "m0"), ("alize", "al", "m0"), ("iciti", "ic", "m0"),
    ("ical", "ic", "m0"), ("ful", "", "m0"), ("ness", "", "m0"),
]
STEM_STEP_4 = [
    ("al", "", "m1"), ("ance", "", "m1"), ("ence", "", "m1"), ("er", "", "m1"),
    ("ic", "", "m1"), ("able", "", "m1"), ("ible", "", "m1"), ("ant", "", "m1"),
    ("ement", "", "m1"), ("ment", "", "m1"), ("ent", "", "m1"), ("ion", "", "st"),
    ("ou", "", "m1"), ("ism", "", "m1"), ("ate", "", "m1"), ("iti", "", "m1"),
    ("ous", "", "m1"), ("ive", "", "m1"), ("ize", "", "m1"),
]

# --- fixed values: endings of inflected English words, and of their base forms ----
LEMMA_ENDINGS = [
    ("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
    ("men", "man"), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""),
    ("ing", "e"), ("ing", ""), ("er", ""), ("est", ""), ("er", "e"), ("est", "e"),
]

# Common English words of four letters or more; shorter ones fall to
# MIN_TOKEN_CHARS.  A default only: every caller may pass another list.
STOP_WORDS = [
    "about", "above", "after", "again", "against", "also", "although", "always",
    "among", "another", "around", "because", "been", "before", "being", "below",
    "between", "both", "cannot", "could", "does", "doing", "down", "during",
    "each", "either", "else", "enough", "even", "ever", "every", "few", "from",
    "further", "have", "having", "here", "hers", "herself", "himself", "however",
    "into", "itself", "just", "less", "made", "many", "more", "most", "much",
    "must", "myself", "neither", "never", "none", "only", "other", "others",
    "ours", "ourselves", "over", "own", "perhaps", "quite", "rather", "same",
    "several", "should", "since", "some", "somehow", "still", "such", "than",
    "that", "their", "theirs", "them", "themselves", "then", "there", "therefore",
    "these", "they", "this", "those", "though", "through", "thus", "together",
    "toward", "towards", "under", "until", "upon", "very", "were", "what",
    "whatever", "when", "where", "whether", "which", "while", "whole", "whom",
    "whose", "will", "with", "within", "without", "would", "your", "yours",
    "yourself", "yourselves",
]
