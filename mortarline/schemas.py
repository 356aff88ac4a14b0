"""Explicit schemas of the file shapes the readers accept, as DDL.

Fixed values: the column names are those of the files and must stay as they are.
"""

FEATURES = (
    "mean_pixel_intensity double, std_pixel_intensity double, image_width double, image_height double, "
    "edge_density double, color_histogram_r double, color_histogram_g double, color_histogram_b double, "
    "predicted_class string"
)
EVAL_CASE = (
    "id string, prompt string, context_docs array<string>, expected_traits struct<has_dimensions:boolean, "
    "has_color_palette:boolean, has_brick_references:boolean, has_floor_plan:boolean, style_matches:string, "
    "story_count:int, building_type:string>, golden_answer_keywords array<string>, known_bad_patterns array<string>, "
    "difficulty string"
)
REQUESTS = (
    "ts timestamp, name string, duration double, success boolean, response_code string, dims map<string,string>"
)
EXCEPTIONS = "ts timestamp, type string, value string, dims map<string,string>"
METRICS = "ts timestamp, name string, value double, dims map<string,string>"
DEPENDENCIES = (
    "ts timestamp, name string, data string, type string, duration double, success boolean, dims map<string,string>"
)
TRACES = (
    "start_time timestamp, duration_ms double, duration double, status string, result_code string, "
    "error_message string, properties map<string,string>"
)
MODEL_LABELS = "filename string, label int"
SPEC_EXAMPLE = (
    "prompt string, spec struct<height:int, style:string, facade:string, roof:string, ground_floor:string, "
    "upper_floors:string, windows:struct<type:string, per_floor:int>, door:struct<type:string, position:string>, "
    "colors:struct<primary:string, secondary:string, accent:string, trim:string>, features:array<string>>"
)
SEARCH_DOCUMENT = "id string, title string, content string, style string, content_vector array<float>"
TELEMETRY = {
    "requests": REQUESTS, "exceptions": EXCEPTIONS, "customMetrics": METRICS, "dependencies": DEPENDENCIES,
    "traces": TRACES,
}
FEATURE_COLUMNS = [
    "filename", "overhang_ratio", "collision_count", "height_to_base_ratio", "layer_density", "label",
]
STATS_COLUMNS = [
    "filename", "total_parts", "brick_count", "plate_count", "slope_count", "window_count", "door_count",
    "height_studs", "width_studs", "depth_studs", "window_to_wall_ratio",
]
