"""Schemas of the tables that stages exchange."""

SOURCE_DOC = "session_id string, path string, content binary, modified timestamp, length bigint"
PAGE_IMAGE = """session_id string, page_number int, success boolean, error string, output_path string, used_dpi int,
    zoom_factor double, original_size_pt struct<width:double,height:double>,
    image_size_px struct<width:int,height:int>, file_size_bytes bigint"""
JUDGMENT = """session_id string, page_number int, image_idx int, judge string, success boolean, error string,
    payload string, raw_response string, attempt int"""
PAGE_STATE = """session_id string, page_number int, success boolean, error string, original_image string,
    processed_image string, processed_images array<string>, needs_dewarping boolean, readability_issues string,
    has_out_of_document boolean, reprocessed_at_scale boolean, dewarping_applied boolean, rotated_count int,
    page_count int, skip_processing boolean"""
TILE = """session_id string, page_number int, source_mask_index int, image_type string, split_index int, split_total int,
    image_path string, source_image string, start_y int, end_y int"""
OCR_RESULT = """session_id string, group_key string, engine string, success boolean, error string, extracted_text string,
    processed_images int, successful_images int, failed_images int, average_confidence double, note string"""
INTEGRATED = "session_id string, engine string, files_count bigint, integrated_text string, total_characters int"
IMAGE = "origin string, height int, width int, nChannels int, mode int, data binary"
