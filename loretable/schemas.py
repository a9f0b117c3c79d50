"""Record types and fixed value pools."""

from __future__ import annotations

CHUNKS = "chunk_id string, source_name string, chunk_idx int, source_file string, chapter_hint string, char_start bigint, char_end bigint, text string"
CANON = (
    "chunk_id string, summary string, characters array<struct<name:string,action:string,emotion:string>>, "
    "events array<struct<event:string,cause:string,result:string>>, locations array<string>, time_markers array<string>, "
    "relationships array<struct<person_a:string,person_b:string,interaction:string>>"
)
STYLE = (
    "chunk_id string, narration_tone string, dialogue_density string, prose_features array<string>, "
    "key_dialogues array<struct<speaker:string,line:string,chunk_id:string>>, style_tags array<string>"
)
RESPONSES = "chunk_id string, attempt int, raw string"
STATE_LOG = "chunk_id string, status string, ts timestamp"

# They must equal those of the records that are read.
SECTION_TYPES = ("story_scene", "author_meta", "front_matter", "in_universe_document", "setting_exposition")
DENSITIES = ("高", "中", "低")
STYLE_TAGS = (
    "吐槽风", "温情", "冷幽默", "热血", "日常感", "诗意", "口语化", "书面化", "意识流", "快节奏",
    "慢节奏", "对话驱动", "描写驱动", "心理描写多", "动作描写多", "第一人称", "第三人称", "轻小说风", "严肃文学风", "网文风",
)
TAG_ALIASES = {"幽默": "冷幽默", "幽默风": "冷幽默", "讽刺幽默": "冷幽默"}
DONE_STATUSES = ("success", "structural_chunk")
REVIEW_LABELS = 8
