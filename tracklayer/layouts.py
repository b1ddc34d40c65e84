"""Record layouts: which columns of a source table make up its encoded record, and in which order.

Every layout follows one rule: the key column first, then the other business columns in the order of the source
table, then the trailing change columns. So a layout needs nothing but the column order of its table, and
``layout_from_columns`` builds one from a landed table's schema. All tables but one are stated below, so that a feed
can be landed and merged from nothing; the widest (SLT) takes its columns from the caller.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Fixed values of the encoded form; stored data and its consumers depend on them.
NA = "NA!@#"  # stands for NULL in an encoded field
TOMBSTONE = "D!@#"  # whole payload of a deleted record
FIELD_SEP = "~"
EVENT_SEP = "|"

CHANGE_COLUMNS = ("op_ts", "op_type", "load_ts")
ENVELOPE_COLUMNS = ("current_ts", "op_ts", "op_type", "pos", "table")

# Columns of the narrow source tables in record order, key first.
COLUMNS = {
    "IBS": """cawbno nstatusid noperationid cmpsno cstatcode cstattype dstatdate cremarks cloccode cemplcode
        cfilename sedptrnx dedptrnx dfilename cprodcode corgarea cdstarea dentdate dlastmodifiedts""",
    "OBS": """cawbno nstatusid noperationid cprodcode corgarea cdstarea cmpsno cstatcode cstattype dstatdate
        cremarks cloccode cemplcode cfilename sedptrnx dedptrnx ccno drundate dlastmodifiedts""",
    "MDP": """cawbno cpickupid cprodcode ccustcode corgarea corgscrcd cdstarea cdstscrcd csubcode cstatcode
        dstatusdate cmloccode cemplcode cdeviceno csimno cgpslat cgpslon cgpstime cgpssatcnt duplddt dsyncdate
        cstatus cpurtcode cispartialpickup creasonofpickuprejection cstatustype cispickupcancelled nputmslot ctype
        dnpudate cmdpickupdetid cremarks""",
    "ALK": """coawbno coorgarea codstarea cnawbno cnorgarea cndstarea namt cprodcode ddate dflightdt cflag
        cprodtype cflightno cloccode ddfiledate""",
    "SRT": """cawbno ctype cemplcode ctimearea dattempdt cemplemail cemplname cattention cnawbno dentdate centtime
        corgarea cdstarea cprodcode ccustcode cmode cmailloc cremarks ccustname ctyp bsryaltinst crecdby crelation
        cstatcode cpuwi dimportdt""",
    "MOD": """cawbno cmpodid cmpoddetid cprodcode corgarea cdstarea cstattype cstatcode dstatdate dstattime
        cemplcode crecdby cdstscrcd crelation cremarks cidtype cidno cdeviceno csimno cgpslat cgpslon dtrack_insert
        dtrack_update cstattime carea cloccode dedpupddt dsyncdate cstatus cgpstime cgpssatcnt""",
    "SFM": """cawbno cmpsno nrunid drundate cruncode corgarea cstattype cstatcode cemplcode cloccode nparrentcontid
        ddtinscan ctally bprinted dstatdate isundelshp isundeliverdate isnotoutscan isnotoutscandate crecdata
        doutscandt boutscan bedptrnx cdstarea cptally nrpcs cdocattach nopcs cflightno dflightdt dloadarrdate
        dfltarrdate cvehicleno nendkms dptallydate cactflightno dactflightdt ctallysrc ddstarrdt cdlvpurtcd
        ctallypurtcd nactparrentcontid cstatemplcode cstatclraction cstatclremplcode dstatclrdate cmstatcode""",
    "ADT": "nawbid ccode cattention csender",
}

# Unqualified source-table name -> family code.
SOURCE_TABLES = {
    "AWBMST": "ABM",
    "SHIPCLT": "SLT",
    "INBOUNDSTATUSREMARK": "IBS",
    "OUTBOUNDSTATUSREMARK": "OBS",
    "CALLPUS": "CPS",
    "MDPICKUP": "MDP",
    "MDPOD": "MOD",
    "SHIPFLTMST": "SFM",
    "AWBLINK": "ALK",
    "SRYALTINST": "SRT",
    "AWBADDRESSDETAILS": "ADT",
}

# Columns of wide source tables in source order. The client detail table, with 219 columns, is a parameter.
WIDE_COLUMNS = {
    "ABM": """nawbid cawbno cprodcode cprodtype corgarea cdstarea cbatchno npcs dshipdate dpudate ntokenno cpuwi
        ndimweight ccustcode ncshmemno ccmdtycode ncolamt namt ctrncode csplinst cpacktype coda cmode
        cgsacode cfodcodflg cfoccode cbtpcode cbtparea cbillno brefno bduty csectyck nparrentcontid
        bbillcnee cpuempcode bstamdart corgscrcd cdstscrcd bpriority csubcode ncurlookupid cputime cflfm
        cdhlacctno crtoarea crtocode cemailid nweight noctroi nduty nsmartboxtypea nsmartboxtypeb ndccount
        cbillcac bcrcrdref ndcrecd cdlvpurtcd caccuracy cdlcode ckgpound cmloccode cadecode dinscandt
        cinscanloc bedptrnx bcrcrdpay biatadtl cdocattach cemplcode nopcs cmustgocrg codocattac
        cdataentryloc bshpcrcrdref deptdtdlv bdetain cisoverage cdhlflag ddemudt ndemuamt cdemucode
        cdemuloccode dstatusdt bcsbprinted ddataentrydt dbatchdt castattype castatcode cstatemplcode
        caremarks captcode bpwpalletized cprintmode cpromocode crtoimtly bdgshipment ispwrec cpreftm crevpu
        cpscode cfrdawbno crfdcompnm crefno2 crefno3 cpumode cputype nitemcnt bpartialpu npaycash nputmslot
        cmanifstno coffcltime ndeferreddeliverydays dcustedd cisddn cactdelloc cgstno cvehicleno cexchawb
        dprefdate cpreftime ndistance dcustpudt ccustputm cavailtime cavaildays cotptype notpno cpackagingid
        cccode""",
    "CPS": """carea cscrcd dregdate cprodcode cprodtype ctrncode ccustcode ccustname ccustadr1 ccustadr2 ccustadr3
        ccustpin ccusttel ccontact dpudate cputime cpupsdtm cremarks npcs nweight ntokenno cdlvpurtcd
        ctrnxpsd cpupsdemp bprinted ccustfax cmobileno cpsdbyemp cloggedby creminder dremdate coffcltime
        cfod ccod coda bpriority caltpurtcd cpuemplcd caltpuemp nsrno ctdd cmode dactpudate cactputime
        cactpuemp creschpu cemailid cbox cstatcode cstattype caltscrcd cregisterby cmodifiedby dmodifieddate
        nvolweight ctopay cpustatus islocked lockinguser cdtp csii cimpexp numberofbox creasonremark
        catmptime cawbno newntokenno dreassigneddate ccallername ccallerphone dreschdate bedptrnx cfilename
        cpuarea cisbulkupld cisdedone crefno etail crawbno dstatusentrydt crevpu nattempted cclstatcode
        cclstattype cclatmptime callstatus cisnewpu cisddn cgstno""",
}

# Columns of the address table in source order.
ADDRESS_COLUMNS = tuple(
    """nawbid cname ccode cattn cpincode cphoneno cmobile cemailid cfax cshipper naddpreference caddress1
        caddress2 caddress3 ccntrycode cstatecode cgstno cgpslat cgpslon cdsource cconmobmask caddresstype
        ccstmobmas crtomobmas""".split()
)

# Families whose first field is trimmed like the key, and whose key is taken as it is.
TRIMMED_FIRST_FIELD = frozenset({"ABM", "IBS", "OBS", "SLT", "MDP"})
UNTRIMMED_KEY = frozenset({"CPS", "ADT"})

# Columns the persistent layer appends to a record, in order.
STATUS_EXTRA = ("stat_cstatgroup", "stat_cstatdesc")
CUSTOMER_EXTRA = (
    "cust_ccompgrp",
    "pack_cprodparent",
    "pack_cprodcommname",
    "pack_csubprdcommname",
    "pack_cprodgroup",
    "cgrpname",
)


@dataclass(frozen=True)
class Layout:
    """Ordered fields of one family's encoded record."""

    family: str
    fields: tuple[str, ...]
    tail: tuple[str, ...] = CHANGE_COLUMNS
    trim_key: bool = True
    trim_first: bool = False

    @property
    def key(self) -> str:
        return self.fields[0]

    @property
    def columns(self) -> tuple[str, ...]:
        """All fields of the incremental record."""
        return self.fields + self.tail

    @property
    def persistent_columns(self) -> tuple[str, ...]:
        """Fields kept by the persistent layer, before the appended master columns."""
        return tuple(c for c in self.columns if c != "load_ts")

    def position(self, column: str) -> int:
        return self.columns.index(column)

    def envelope_schema(self) -> T.StructType:
        """Schema of the JSON change envelope; every business field is a nullable string."""
        after = T.StructType([T.StructField(c, T.StringType()) for c in self.fields])
        rest = [T.StructField(c, T.StringType()) for c in ENVELOPE_COLUMNS]
        return T.StructType([T.StructField("after", after), *rest])

    def landed_schema(self) -> T.StructType:
        """Schema of the landed table; ``load_ts`` is its partition column, pinned to a long."""
        strings = [T.StructField(c, T.StringType()) for c in (*self.fields, "op_ts", "op_type")]
        return T.StructType([*strings, T.StructField("load_ts", T.LongType())])


def layout_from_columns(family: str, columns: Iterable[str], key: str | None = None) -> Layout:
    """Layout of a table from its column order (``df.columns``); change and envelope columns are left out."""
    skip = {*CHANGE_COLUMNS, *ENVELOPE_COLUMNS}
    business = [c.lower() for c in columns if c.lower() not in skip]
    first = (key or ("ntokenno" if family == "CPS" else "cawbno")).lower()
    if first not in business:
        raise ValueError(f"key column {first!r} is not among the columns of {family}")
    fields = (first, *(c for c in business if c != first))
    layout = Layout(family, fields, trim_key=family not in UNTRIMMED_KEY, trim_first=family in TRIMMED_FIRST_FIELD)
    if family == "CPS":
        # The pickup record carries its company group before the load stamp.
        layout = replace(layout, tail=("op_ts", "op_type", "cust_ccompgrp", "cgrpname", "load_ts"))
    return layout


def default_layouts(wide: Mapping[str, Iterable[str]] | None = None) -> dict[str, Layout]:
    """Layouts of all families with stated columns, and of those whose column order is given (family -> columns)."""
    layouts = {
        family: Layout(
            family,
            tuple(text.split()),
            tail=("op_ts",) if family == "ADT" else CHANGE_COLUMNS,
            trim_key=family not in UNTRIMMED_KEY,
            trim_first=family in TRIMMED_FIRST_FIELD,
        )
        for family, text in COLUMNS.items()
    }
    stated = {family: text.split() for family, text in WIDE_COLUMNS.items()}
    for family, columns in {**stated, **(wide or {})}.items():
        layouts[family] = layout_from_columns(family, columns)
    return layouts
