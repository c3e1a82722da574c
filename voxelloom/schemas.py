"""Explicit schemas of what is read and written."""

TILE_RESULT = "slice_name string, x1 double, y1 double, x2 double, y2 double, class_name string, score double, mean double, z double"
DETECTION = "det_id bigint, tile_no bigint, z bigint, class bigint, x1 double, y1 double, x2 double, y2 double, score double, mean double"
LAYOUT = "tile_no bigint, row bigint, col bigint, abs_x bigint, abs_y bigint, abs_z bigint, tile_name string"
GLOBAL_BOX = "x1 double, y1 double, x2 double, y2 double, score double, mean double, class double, z double, tile_name string, slice_name string"
CHANNEL_QC = "mean_intensity double, sharpness double, saturation_ratio double, drift double, cv_bright_spots int, miss_ratio double, avg_conf double, median_conf double, low_conf_ratio double"
TILE_QC = "z int, detection_count int, " + ", ".join(f"{p}_{c.strip()}" for p in ("c1", "c2") for c in CHANNEL_QC.split(",")) + ", logic_mismatch_rate double, yellow_balance double"
