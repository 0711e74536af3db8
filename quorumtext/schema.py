"""Row types of the engine. Order is data: every tie-breaker is a column (engine_ord, angle_ord, variant_ord, line_no)."""

from __future__ import annotations

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
LINE = f"struct<text:string,bbox:{BOX},confidence:double,source:string>"
META = "struct<rotation_angle:int,page_width:int,page_height:int,line_count:int,method:string,winner:string,sources:array<string>>"

#: A line that an engine read: raw_confidence is null where the engine gave none.
OCR_LINE = f"page_id bigint, angle int, angle_ord int, engine string, engine_ord int, variant string, variant_ord int, line_no int, text string, bbox {BOX}, raw_confidence double"
PAGE = "page_id bigint, pdf_name string, page int, page_width double, page_height double, layer_text string, layer_ok boolean"
CANDIDATE = "page_id bigint, angle int, angle_ord int, engine string, engine_ord int, text string, confidence double, variant string, line_count int"
FUSED = "page_id bigint, angle int, angle_ord int, engine string, text string, confidence double, variant string, method string, winner string, sources array<string>"
MANIFEST = "pdf_path string, page int"
RICH_MANIFEST = "pdf_path string, page_no int, original_pdf string, original_page int, gold_text string"
PAGE_OUTPUT = "pdf_name string, page int, page_text string, has_akkadian boolean"
PROGRESS = "pdf_name string, page int, ms bigint, used_text_layer boolean, has_akkadian boolean, timestamp timestamp_ntz"
EVALUATION = "pdf string, page int, engine string, time double, boxes int, cer double, accuracy double, ocr_len int, gold_len int"
EXTRACTION = "gold_row_idx int, source_pdf string, page int, output_file string"
