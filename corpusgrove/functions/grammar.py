"""Line formats of topic files, seed files and completion responses."""

# The line patterns users' prompts and topic files rely on.
TOPIC_FILE_LINE = r"^\[(\d+)\] (.+) \(Count: (\d+)\)\s?:(.+)?"
SEED_FILE_LINE = r"^\[(\d+)\] (.+)"
LEVEL1_LINE = r"^\[(\d+)\] ([\w\s\+_#-]+):(.+)"
DOC_TOPIC_LINE = r"^\[(\d+)\] ([\w\s+_#\-]+):(.+)"
SUBTOPIC_LINE = r"^\[(\d+)\] ([\w\s\-'\&,]+)(\(Document(?:s)?: ((?:(?:\d+)(?:(?:, )?)|-)+)\)([:\-\w\s,.\n'\&]*?))?$"
MERGE_LINE = r"^\[(\d+)\]([\w\s',_+#\-]+)[^:]*:([\w\s,\.\-\/;']+) \(([^)]+)\)$"
MERGE_ORIGINAL = r"\[(\d+)\]([\w\s',_+#\-]+),?"
ASSIGNED_TOPIC = r"^\[\d+\] ([\w\s\-'\&]+):"
FIRST_TOPIC = r"\[(?:\d+)\] ([^:]+): (?:.+)"

# Default token: a run of letters, marks, digits and underscores, or one other
# visible character.  Whitespace never counts, so counts add up across it.
TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"
SPACED_TOKEN = r"\s*(?:[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s])"

# Defaults of the stages.
MAX_TOPIC_TOKENS = 500
EARLY_STOP = 1000
MAX_TOKENS = 1000
CONTEXT_WINDOWS = {"gpt-3.5-turbo": 4096, "gpt-4": 8000}
DEFAULT_CONTEXT_WINDOW = 128000
TEMPERATURE, TOP_P = 0.0, 1.0
CORRECTION_TEMPERATURE, CORRECTION_TOP_P = 0.6, 0.9
PAIR_THRESHOLD, PAIRS_PER_PROMPT = 0.5, 2
RARE_SHARE = 0.01
EXPAND_SHARE = 0.01
PACK_FRACTION = 5
CORRECTION_TOPIC_FLOOR = 50
TRIES, RETRY_WAIT = 3, 60.0
SYSTEM_MESSAGE = "You are a helpful assistant."
REASSIGN_MESSAGE = (
    "Previously, this document was assigned to: ",
    ". Please reassign it to an existing topic in the hierarchy.",
)


def java(pattern: str, multiline: bool = False) -> str:
    """The pattern with Unicode classes and newline-only line ends for Spark."""
    return ("(?Udm)" if multiline else "(?Ud)") + pattern


def context_length(model: str = "", max_tokens: int = MAX_TOKENS) -> int:
    return CONTEXT_WINDOWS.get(model, DEFAULT_CONTEXT_WINDOW) - max_tokens
