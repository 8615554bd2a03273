"""Fixed domain values.

The values in the block below must equal the ones the original pipeline uses, otherwise
results differ; they are stated plainly and in their natural order.
"""

# ---- fixed values (must match the original pipeline) -------------------------------
# default spectral bands, in stack order
BANDS = ["B02", "B03", "B04", "B8A", "B11", "B12"]
# non-spectral layers that also carry a granule-id suffix
NON_SPECTRAL = ["Fmask", "VAA", "VZA", "SAA", "SZA"]
# the nine documented spectral bands, in the order the composite indices refer to
NINE_BANDS = ["B02", "B03", "B04", "B05", "B06", "B07", "B8A", "B11", "B12"]
# widening search windows (days either side of a time point)
WINDOWS = [3, 7, 14, 30]
# composite presets: name -> (red, green, blue) as indices into NINE_BANDS
COMPOSITE_PRESETS = [
    ("natural", [2, 1, 0]),
    ("false_color_nir", [6, 2, 1]),
    ("agriculture", [6, 5, 2]),
    ("urban", [7, 6, 2]),
    ("vegetation", [6, 3, 2]),
]
# percentile stretch limits
STRETCH_LOW = 0.02
STRETCH_HIGH = 0.98
# change detection uses this band index within one date
CHANGE_BAND_INDEX = 3
# number of time points per field
N_TIME_POINTS = 3
# granule-guard limit in interactive mode
MAX_INTERACTIVE_GRANULES = 3
# default result caps: download search, listing
MAX_RESULTS_DOWNLOAD = 50
MAX_RESULTS_LISTING = 10
# batch report shows this many names per list
REPORT_TOP = 10
# stack pixel type range (uint16) and nodata value
PIXEL_MIN = 0
PIXEL_MAX = 65535
NODATA = 0
# ------------------------------------------------------------------------------------

# WGS84 ellipsoid (public constants of the datum)
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
