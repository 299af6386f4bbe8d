"""Record layouts and table schemas."""

from __future__ import annotations

import numpy as np

#: Fields of the raw records, in order, with C types and alignment.
V325 = np.dtype([
    ("week", "<i4"), ("towe", "<f4"), ("leap", "u1"), ("cons", "u1"), ("sats", "u1"), ("svid", "u1"), ("elev", "i1"), ("azim", "<i4"),
    ("snr1", "u1"), ("snr2", "u1"), ("snr3", "u1"), ("pst1", "u1"), ("pst2", "u1"), ("pst3", "u1"), ("rst1", "u1"), ("rst2", "u1"), ("rst3", "u1"),
    ("cph1", "<f8"), ("cph2", "<f8"), ("cph3", "<f8"), ("rng1", "<f8"), ("rng2", "<f8"), ("rng3", "<f8"), ("lon", "<f4"), ("lat", "<f4"), ("hei", "<f4"),
], align=True)
V326 = np.dtype([
    ("towe", "<f4"), ("cons", "u1"), ("sats", "u1"), ("svid", "u1"), ("elev", "i1"), ("azim", "<i4"), ("snr1", "u1"), ("snr2", "u1"),
    ("pst1", "u1"), ("pst2", "u1"), ("rst1", "u1"), ("rst2", "u1"), ("cph1", "<f8"), ("cph2", "<f8"), ("rng1", "<f8"), ("rng2", "<f8"), ("lck1", "<i4"), ("lck2", "<i4"),
], align=True)
#: The v326 header, of which the last field is the GPS week, and where its records begin.
V326_HEADER, V326_RECORDS = "@fBbiBBBBBBddddi", 128
#: Positions and names of the v324 text fields.
V324 = {0: "week", 1: "towe", 3: "cons", 4: "svid", 5: "elev", 6: "azim", 7: "snr1", 8: "snr2", 9: "cph1", 11: "cph2", 13: "rng1", 15: "rng2"}
#: Columns left out of lvl0.
UNUSED = ("sats", "pst1", "pst2", "rst1", "rst2", "lck1", "lck2")
#: The columns of the commercial receiver's minute files.
ISMR = (
    "WN TOW SVID RxState Azimuth Elevation AvgCNo1 TotalS4_1 CorrectionS4_1 Phi01_1 Phi03_1 Phi10_1 Phi30_1 Phi60_1 AvgCCD_1 SigmaCCD_1 "
    "TEC_TOW_45s dTEC_60s_45s TEC_TOW_30s dTEC_45s_30s TEC_TOW_15s dTEC_30s_15s TEC_TOW dTEC_15s_TOW LockTime_Sig1 sbf2ismrVersion "
    "LockTime_Sig2_TEC AvgCNo2_TEC SI_Index_1 SI_Index_Numerator_1 p_1 AvgCNo2 TotalS4_2 CorrectionS4_2 Phi01_2 Phi03_2 Phi10_2 Phi30_2 "
    "Phi60_2 AvgCCD_2 SigmaCCD_2 LockTime_Sig2 SI_Index_2 SI_Index_Numerator_2 p_2 AvgCNo3 TotalS4_3 CorrectionS4_3 Phi01_3 Phi03_3 "
    "Phi10_3 Phi30_3 Phi60_3 AvgCCD_3 SigmaCCD_3 LockTime_Sig3 SI_Index_3 SI_Index_Numerator_3 p_3 T_Sig1 T_Sig2 T_Sig3"
).split()

_SPARK = {"u1": "smallint", "i1": "tinyint", "<i4": "int", "<f4": "float", "<f8": "double"}


def spark_fields(dtype: np.dtype) -> dict[str, str]:
    """Column types that hold a record's fields; unsigned bytes are widened."""
    return {name: _SPARK[dtype[name].str.lstrip("|")] for name in dtype.names}
