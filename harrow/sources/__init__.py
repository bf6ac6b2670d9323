from harrow.sources.json_documents import json_array_elements, write_json_arrays  # noqa: F401
from harrow.sources.readers import (  # noqa: F401
    literal_table,
    read_compressed_lines,
    read_csv,
    read_delimited,
    read_jdbc,
    read_json_document,
    read_json_lines,
    read_lines,
    read_stop_words,
    register_views,
    schema_table,
    split_lines,
    text_date,
    without_lines_containing,
    write_csv,
)
from harrow.sources.variants import json_rows  # noqa: F401
