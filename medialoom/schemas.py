"""Schemas of the tables that are read and written."""

# column names and order are fixed values of the stored files
GENERATED_METADATA = (
    "filename string, prompt string, label string, model string, type string, "
    "release_date string, packaged boolean"
)
INPAINT_METADATA = (
    "filename string, prompt string, label string, model string, type string, "
    "release_date string, source_image_url string, mask_url string, mask_path string, "
    "class_name string"
)
POST_METADATA = (
    "filename string, label string, subreddit string, post_date string, reddit_id string, "
    "packaged boolean"
)
METADATA = {
    "generated": GENERATED_METADATA,
    "inpaint": INPAINT_METADATA,
    "posts": POST_METADATA,
}
PROMPT_ROWS = (
    "ImageID string, MaskPath string, LabelName string, ClassName string, generated_prompt string"
)
CLASSES = "LabelName string, ClassName string"
NARRATIVES = "image_id string, caption string"
REGISTRY = "model_id string, status string, reason string, date string, ord bigint"
REGISTRY_ENTRY = "status string, reason string, date string"
POSTS = (
    "id string, source string, created_utc double, url string, is_video boolean, "
    "media struct<reddit_video:struct<fallback_url:string>>"
)
CATALOGUE = (
    "id string, tags array<string>, cardData struct<base_model:variant>, pipeline_tag string, "
    "downloads bigint, created_at timestamp, siblings array<struct<rfilename:string>>"
)
UPLOADED = "name string"
