"""Fixed values that results depend on: gates, thresholds, word lists, templates."""

# --- Fixed values: discovery -------------------------------------------------
MODEL_CATEGORIES = {
    "code": ["starcoder", "codellama", "deepseek-coder", "qwen2.5-coder"],
    "reasoning": ["mistral", "llama", "qwen", "gemma"],
    "chat": ["zephyr", "openchat", "neural-chat"],
    "medical": ["meditron", "biomedlm", "llama-med"],
    "multilingual": ["aya", "bloomz", "xglm"],
}
TASK = "text-generation"
PER_KEYWORD = 50
TOP_K = 5
MIN_DOWNLOADS = 1000
MIN_LIKES = 10
MAX_PARAMS_B = 10.0
SIZE_SUFFIXES = ["b", "b-instruct", "b-chat"]
CARD_HEADINGS = [
    "## Model Details",
    "## Intended Uses",
    "## Training",
    "## Evaluation",
    "## Limitations",
]
PROBE_TEXTS = [
    "The transformer architecture consists of",
    "To implement a binary search tree in Python,",
    "The causes of World War II include",
    "Recent advances in large language models show",
]

# --- Fixed values: layer kinds, first matching rule wins ---------------------
LAYER_KINDS = {
    "embedding": ["embed_tokens", "wte", "word_embeddings"],
    "attention": ["self_attn", "attention", "attn", "q_proj", "k_proj", "v_proj", "o_proj"],
    "mlp": ["mlp", "ffn", "feed_forward", "gate_proj", "up_proj", "down_proj", "fc1", "fc2"],
    "norm": ["norm", "layer_norm", "layernorm", "rmsnorm"],
    "head": ["lm_head", "embed_out", "output"],
}

# --- Fixed values: merging ---------------------------------------------------
MERGE_STRATEGIES = ["slerp", "ties", "dare_ties", "task_arithmetic", "breadcrumbs"]
DENSITY = 0.7
SCALING = 0.5
EPSILON = 0.01
LORA_RANK = 16
LORA_ALPHA = 32

# --- Fixed values: scoring ---------------------------------------------------
HALLUCINATION_PATTERNS = [
    r"\b(definitely|certainly|always|never|everyone|nobody)\b",
    r"\b(100%|absolutely|guaranteed)\b",
    r"\bin \d{4},? .{0,30} (invented|discovered|created|founded)\b",
]
NLI_CONTEXT_CHARS = 512
NLI_PREDICTION_CHARS = 256
NEUTRAL_FAITHFULNESS = 0.5
HALLUCINATED_BELOW = 0.3
DEFAULT_JUDGE = 5.0
JUDGE_PROMPT = """You are an expert evaluator. Score the following answer on a scale of 0-10.

Question: {question}
Reference Answer: {reference}
Model Answer: {prediction}

Evaluation criteria:
- Accuracy (does it match the reference?)
- Completeness (does it cover all key points?)
- Clarity (is it well-expressed?)
- Faithfulness (no hallucinations?)

Respond ONLY with: SCORE: <integer 0-10>
REASON: <one sentence>
"""
GAP_THRESHOLDS = {"rouge": 0.30, "bertscore": 0.50, "faithfulness": 0.50, "judge": 5.0}
GAP_KEYWORDS = {
    "factual_recall": ["who", "when", "where", "what year", "which country"],
    "multi_step_reasoning": ["therefore", "because", "if", "then", "step"],
    "numerical": ["how many", "calculate", "percent", "number", "count"],
    "code_generation": ["write a function", "implement", "code", "python", "sql"],
    "summarization": ["summarize", "summary", "main points", "briefly"],
}
GAP_MIN_FAILURES = 2

# --- Fixed values: synthetic rows and training text --------------------------
FALLBACK_GAP = "factual_recall"
GAP_PROMPTS = {
    "factual_recall": """Generate {n} high-quality QA pairs testing factual recall.
Format each as JSON: {"context": "...", "question": "...", "answer": "..."}
Focus on: historical dates, scientific facts, geography, key figures.
Return a JSON array only.""",
    "multi_step_reasoning": """Generate {n} QA pairs requiring multi-step reasoning.
Format each as JSON: {"context": "...", "question": "...", "answer": "..."}
Each answer must show intermediate reasoning steps.
Return a JSON array only.""",
    "numerical": """Generate {n} QA pairs involving numerical calculations or statistics.
Format each as JSON: {"context": "...", "question": "...", "answer": "..."}
Include percentages, comparisons, and mathematical relationships.
Return a JSON array only.""",
    "code_generation": """Generate {n} coding QA pairs.
Format each as JSON: {"context": "function specification", "question": "implementation task", "answer": "working code"}
Cover: Python functions, algorithms, data structures.
Return a JSON array only.""",
    "summarization": """Generate {n} summarization QA pairs.
Format each as JSON: {"context": "long passage", "question": "summarize this", "answer": "concise summary"}
Vary context length 200-800 words.
Return a JSON array only.""",
}
ROWS_PER_GAP = 50
CHAT_TEMPLATE = "<s>[INST] Context: {context}\n\nQuestion: {question} [/INST] {answer}</s>"
CHAT_MARKER = " [/INST]"
MAX_SEQ_LENGTH = 2048
TRAIN_BATCH = 4
TARGET_ROUGE = 0.45

# --- Fixed values: workload and reports --------------------------------------
WORKLOAD_TOPICS = [
    "machine learning",
    "quantum computing",
    "climate change",
    "evolution",
    "blockchain",
]
WORKLOAD_REPEATS = 10
WORKLOAD_REQUESTS = 50
LEADERBOARD_ROWS = 10
LEADERBOARD_ID_CHARS = 40
# (run column, tracker name, bare name)
RUN_METRICS = [
    ("avg_rouge1", "eval/rouge1", "rouge1"),
    ("avg_rouge2", "eval/rouge2", "rouge2"),
    ("avg_rougeL", "eval/rougeL", "rougeL"),
    ("avg_bertscore", "eval/bertscore", "bertscore"),
    ("avg_faithfulness", "eval/faithfulness", "faithfulness"),
    ("hallucination_rate", "eval/hallucination_rate", "hallucination_rate"),
    ("avg_judge_score", "eval/judge_score", "judge_score"),
    ("tokens_per_sec", "perf/tokens_per_sec", "tokens_per_sec"),
]

# --- Fixed values: labels of the evaluation reports ---------------------------
COMPARED = {
    "ROUGE-1": "avg_rouge1",
    "BERTScore": "avg_bertscore",
    "Faithfulness": "avg_faithfulness",
    "Halluc. %": "hallucination_rate",
    "Judge": "avg_judge_score",
}
SHOWN = {
    "ROUGE-1": "avg_rouge1",
    "ROUGE-2": "avg_rouge2",
    "ROUGE-L": "avg_rougeL",
    "BERTScore F1": "avg_bertscore",
    "Faithfulness": "avg_faithfulness",
    "Hallucination %": "hallucination_rate",
    "Judge Score": "avg_judge_score",
}
