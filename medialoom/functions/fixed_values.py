"""Fixed values that results depend on: quotas, word lists, codes, formats."""

# --- fixed values -----------------------------------------------------------
DOWNLOAD_FLOOR = 30000
CATALOGUE_LIMIT = 1000
WEIGHT_SUFFIX = ".safetensors"

QUOTAS = {"Base": 10000, "Fine-tune": 5000, "LoRA": 2000}
ADAPTER_TAGS = ["lora", "peft", "adapter"]
BASE_TAG_PREFIX = "base_model:"
NO_BASE = "None"

BANNED_TASK_WORDS = {
    "generate": ["audio", "3d"],
    "inpaint": ["audio", "3d", "video"],
    "count": ["video", "audio", "3d"],
}

COMPLETED = "COMPLETED"
MODEL_FAULT = "MODEL_FAULT"
INFRASTRUCTURE_FAULT = "INFRASTRUCTURE_FAULT"
HALT = "HALT"
FINAL_STATUSES = [COMPLETED, MODEL_FAULT]

REASON_NO_WEIGHTS = "No safetensors found"
REASON_TASK = "Incompatible task: %s"
REASON_NO_BASE = "Missing base model dependency"
REASON_SHORT = "Only %d masks available, need %d"

EXIT_OK = 0
EXIT_DATA_FAULT = 10
EXIT_MODEL_FAULT = 11
EXIT_MEMORY_FAULT = 12
EXIT_CODE_BUG = 14
MEMORY_EXITS = [12, 137, 9]
EXIT_NAMES = {
    "halt": "Critical Code Bug",
    "model": "Incompatible Architecture",
    "memory": "Node/GPU Out of Memory",
    "data": "Data/Path Typo",
    "other": "Generic Slurm/Job Failure",
}

OUT_OF_MEMORY_TEXT = "cuda out of memory"
MISSING_FILE_TEXT = "no such file or directory"
FILE_ERROR_CLASSES = ["FileNotFoundError", "OSError"]
MODEL_FILE_WORDS = ["model_index.json", "config.json", "scheduler", "huggingface", "safetensors"]
ARCHITECTURE_WORDS = [
    "weight", "pipeline", "expected str", "time embedding", "incorrect config", "dimension",
]
VIDEO_ARCHITECTURE_WORDS = ARCHITECTURE_WORDS + ["black image"]

IMAGE_ENDINGS = [".jpg", ".jpeg", ".png"]
LOOKBACK_DAYS = 1000
POST_FRAMES = 15
GENERATED_FRAMES = 10

AI_SOURCES = [
    "aigeneratedart", "aiArt", "midjourney", "aiimages", "AiArtwork", "AiGeneratedArt",
    "Pro_Ai_Art", "AI_ART", "aivideo", "AIVideos_SFW", "GenAIGallery", "deepdream",
    "nanobananaSFW", "VEO3", "Seedance_A", "KlingAI_Videos", "GrokImage",
]
REAL_SOURCES = [
    "photography", "itookapicture", "pics", "EarthPorn", "CityPorn", "FoodPorn",
    "StreetPhotography", "analog", "photocritique", "WildlifePhotography", "MacroPorn",
    "SkyPorn", "portraitphotography", "MODELING", "AmateurPhotography", "portraits",
    "casual_photography", "portraitphotos",
]

SOURCE_IMAGE_BASE = "https://s3.amazonaws.com/open-images-dataset/train"
MASK_BASE = "https://storage.googleapis.com/openimages/v5/train-masks/train-masks-"
DEFAULT_PROMPT = "a realistic replacement"

UNSAFE_LABEL = "nsfw"
UNSAFE_THRESHOLD = 0.7
SCORE_BATCH = 64
PROMPT_BATCH = 32

MISSING_CLASS = "Object"
RELATIONS_PER_IMAGE = 8
CAPTION_CHARS = 300
EMBEDDED_PROMPT_PATTERN = r'\{[^{}]*"prompt"\s*:\s*"([^"]+)"[^{}]*\}'

FEED_POST_KEYS = ["posts", "items", "results", "data", "generations"]
FEED_CURSOR_KEYS = ["cursor", "next_cursor", "next", "nextCursor", "next_page"]
FEED_NESTED_CURSOR_KEYS = ["cursor", "next_cursor", "next"]
FEED_VIDEO_HOST = "videos.openai.com"
FEED_QUALITIES = ["source", "md", "ld"]
UNSAFE_NAME_CHARS = r'[<>:"/\\|?*\x00-\x1f]'
MAX_NAME_CHARS = 80
MAX_FEED_VIDEOS = 50

SHARD_ROWS = 500
SHARD_BYTES = 5 * 1000**3
FILES_PER_COMMIT = 10
SHARD_NAME = "train-%05d-of-%05d.parquet"
SHUFFLE_SEED = 42

TYPE_BASE_COUNT = 8000
TYPE_FINE_TUNE_COUNT = 4000
DATED_TAIL = r"_(\d{4}-\d{2}-\d{2})_\d+$"
INDEX_TAIL = r"_\d+$"
# texts of the best context, by tier
CONTEXT_NARRATIVE = 'Image description: "%s"\n'
CONTEXT_RELATIONS = "Scene relationships: %s\n"
CONTEXT_OBJECTS = "Objects in the image: %s\n"
CONTEXT_CLASS = "Object to replace: %s"
RELATION_SEPARATOR = "; "
OBJECT_SEPARATOR = ", "
LEGACY_DESCRIPTION = "An image containing a %s"

# file names
GENERATED_NAME = "hf_%s_%s_%d.png"
INPAINT_NAME = "inpaint_%s_%s_%d.png"
VIDEO_FRAME_NAME = "hf_vid_%s_%s_%d_frame%d.png"
POST_NAME = "reddit_%s_%s_%s"
POST_FRAME_NAME = "%s_frame_%d.jpg"
CACHE_FOLDER_PREFIX = "models--"
ARCHIVE_FOLDER_PREFIX = "train-masks-"
COMMIT_MESSAGE = "Add %s shards: %s to %s"
UPLOAD_PATH = "%s/train/%s"

# tasks that share a quota
TASKS = {"Base": 10, "Fine-tune": 5, "LoRA": {"generate": 2, "inpaint": 3}}
START_BATCH = {"image": 12, "inpaint": 4, "video": 2}

# mask expansion: shares of the shorter side, limits in pixels, odds of the edge kinds
JOB_SHARE = (0.02, 0.08)
JOB_LEAST_PIXELS = 3
JOB_BLURS = [3, 5, 7]
ONCE_SHARE = (0.03, 0.10)
ONCE_PIXELS = (5, 80)
ONCE_HEIGHT_CHANGE = 3
ONCE_SINGLE_ROUND = 0.8
ONCE_SHARP = 0.4
ONCE_SLIGHT = 0.4
SLIGHT_BLURS = [3, 5]
MODERATE_BLURS = [5, 7, 9]
THRESHOLD = 127
MODERATE_THRESHOLD = 100
# --- end of fixed values ----------------------------------------------------
