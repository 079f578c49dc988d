"""Schemas of the tables that pass between jobs."""

MANIFEST = "video_id string, url string, title string, category string, duration double"

LISTING = "video_id string, path string, file_size bigint, is_valid boolean, error_message string"

PROBE = (
    "video_id string, path string, duration double, resolution string, fps double, codec string,"
    " bitrate bigint, has_audio boolean, file_size bigint, processing_status string"
)

# The probe tool prints durations and bit rates as text and sizes as numbers.
PROBE_JSON = (
    "struct<format:struct<duration:string,bit_rate:string>,"
    "streams:array<struct<codec_type:string,codec_name:string,width:string,height:string,"
    "r_frame_rate:string>>,_broken:string>"
)

FRAME = (
    "video_name string, video_path string, frame_number bigint, timestamp double,"
    " frame_data binary, shape array<int>, quality_category string"
)

KEYFRAME = (
    "video_name string, frame_number bigint, timestamp double, cluster bigint,"
    " gaussian_smoothed_features array<double>"
)

CLIP = (
    "transcript string, num_segments int, duration double, mfcc_features array<double>,"
    " error string"
)

KEYWORDS = "array<struct<word:string,frequency:bigint>>"

TERMS = "array<struct<term:string,n:bigint,position:int>>"

TOP_TERMS = "array<struct<term:string,score:double>>"
